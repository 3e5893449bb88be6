"""One query for each operator, over its whole table, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm import chat, decontam, imatch, linededup, mixing, phrases, planes, quality, sepscan, simhash, vafile, warc, whitening
from vialflow.llm.common import table
from vialflow.session import scratch_path

SHINGLE, RADIUS = 3, 2
END_ID, SEPARATOR = 1, 49407
THRESHOLD = 0.3


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, radius=RADIUS)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat an earlier line, nearly or wholly."""
    return linededup.line_report(table(spark, sf_dir, "documents"), by_row=True)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through a content-addressed archive and back."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.digest_rows(spark, path)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return imatch.with_edited(table(spark, sf_dir, "documents"))


def op6_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids through plane files and back."""
    path = scratch_path(spark, "planes")
    planes.write_ids(table(spark, sf_dir, "documents"), path, vocabulary(), END_ID)
    return planes.read_ids(spark, path, digest=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of all documents by source."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by a separator scan of flat token files."""
    path = scratch_path(spark, "flat")
    sepscan.write_flat(table(spark, sf_dir, "documents"), path, vocabulary(), SEPARATOR)
    return sepscan.count_tokens(spark, path, SEPARATOR)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of all maximal conversations."""
    return chat.rendered_turns(table(spark, sf_dir, "conversations"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    scores = quality.scored(docs, model, threshold=THRESHOLD)
    return scores.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the 16 leading components of the distinct ones."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), top=16, scale=64, offset=1_000_000)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language, from all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"), support=10, longest=3, top=2000, absorbed=50)


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other embeddings for every embedding whose id is divisible by 50."""
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_line_dedup, op3_warc, op4_decontamination, op5_imatch, op6_token_planes, op7_mixing, op8_token_counts, op9_chat, op10_quality, op11_whitening, op12_phrases, op13_top_k)
}

_BASE32 = "||".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex_sha1, {5 * i + 1}, 5))::BIGINT >> {15 - 5 * j}) & 31)::INT, 1)" for i in range(8) for j in range(4)
)

ORACLE: dict[str, str] = {
    "op3_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        m AS (SELECT body, min(page_id) AS first, sha1(body) AS hex_sha1 FROM p GROUP BY body),
        d AS (SELECT body, first, {_BASE32} AS payload_digest FROM m)
        SELECT page_id, strlen(p.body)::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN d ON p.body = d.body""",
    "op4_decontamination": r"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
        iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
        i5 AS (SELECT item_id, w, least(len(w), 5) AS n FROM iw WHERE len(w) > 0),
        ig AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
               FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM i5)),
        ic AS (SELECT item_id, count(*) AS item_shingles FROM ig GROUP BY item_id),
        dg AS (SELECT DISTINCT doc_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, (SELECT DISTINCT n FROM i5) WHERE len(w) >= n))
        SELECT doc_id, item_id, any_value(item_shingles)::INT AS item_shingles, count(*)::INT AS shared,
               count(*) / any_value(item_shingles)::DOUBLE AS containment
        FROM dg JOIN ig USING (n, g) JOIN ic USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) >= any_value(item_shingles) * 0.8 - 1e-9""",
    "op9_chat": r"""
        WITH c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn) AS turns FROM conversations GROUP BY conv_id),
        u AS (SELECT min(conv_id) AS conv_id, turns FROM c GROUP BY turns),
        p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM u)),
        kept AS (SELECT conv_id FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = u.turns))
        SELECT conv_id, turn, '<|' || regexp_replace(coalesce(role, ''), '([|\\])', '\\\1', 'g') || '|>' || chr(10)
               || regexp_replace(coalesce(text, ''), '<([|\\])', '<\\\1', 'g') || chr(10) AS segment
        FROM conversations SEMI JOIN kept USING (conv_id)""",
    "op12_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10),
        cuts AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
                 FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
        s AS (SELECT lang, cuts.phrase, cuts.a, j, l.a AS l, r.a AS r,
                     (1000000::HUGEINT * cuts.a * cuts.a // (l.a::HUGEINT * r.a))::BIGINT AS score
              FROM cuts JOIN f l USING (lang) JOIN f r USING (lang) WHERE l.phrase = x AND r.phrase = y),
        worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inside AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op13_top_k": """
        WITH v AS (SELECT row_number() OVER () AS row, vec_id, [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
                   FROM embeddings WHERE len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
        s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
              FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
}
