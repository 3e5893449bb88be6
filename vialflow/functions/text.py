"""Text column expressions: label extraction, redaction, file-name slugs.

Each expression is defined once as Spark SQL text (``*_sql``), used by the
SQL plans directly and by the DataFrame helpers through ``F.expr``. All are
JVM-side regex expressions: whole-stage codegen, no Python UDF.

Java regex differs from Python's ``re`` in two places that matter here:
``.`` also stops at ``\\r``/U+0085/U+2028/U+2029 and ``\\d`` is ASCII-only.
``(?d)`` (Unix lines) and ``(?U)`` (Unicode classes) restore Python's meaning.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sqltext import quote

# Fixed values that must equal the original job's patterns: the two labels
# read from a vial's comment field.
SAMPLEID_PATTERN = r"SAMPLEID:(.*?),"
LAB_ID_PATTERN = r"LAB_ID:(\d+)"
PYTHON_RE_FLAGS = "(?dU)"
# Fixed value: the connection-string label whose value is masked.
DSN_PASSWORD_LABEL = "PWD="

# Fixed values for file-name slugs: Latin letters with diacritics and the
# ASCII letter each becomes (position by position), then letters that become
# two ASCII letters. A comma between two digits is dropped ("1,000" -> "1000").
LATIN_FROM = (
    "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
    "ĀāĂăĄąĆćČčĎďĒēĘęĚěĞğĪīİıĽľŁłŃńŇňŌōŐőŘřŚśŠšŞşŤťŪūŮůŰűŹźŻżŽž"
)
LATIN_TO = (
    "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
    "AaAaAaCcCcDdEeEeEeGgIiIiLlLlNnNnOoOoRrSsSsSsTtUuUuUuZzZzZz"
)
LATIN_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d",
               "Þ": "TH", "þ": "th"}
assert len(LATIN_FROM) == len(LATIN_TO)
DIGIT_COMMA = r"(?<=[0-9]),(?=[0-9])"


def python_re(pattern: str) -> str:
    """Java pattern that matches like Python's ``re`` on the same text."""
    return PYTHON_RE_FLAGS + pattern


def first_match_sql(col: str, pattern: str, group: int = 1) -> str:
    """Group ``group`` of the first match; NULL when nothing matches.

    ``regexp_extract`` alone returns ``''`` both for "no match" and for an
    empty capture; the ``RLIKE`` guard keeps those apart (an empty capture
    stays ``''``).
    """
    rx = quote(python_re(pattern))
    return f"CASE WHEN {col} RLIKE {rx} THEN regexp_extract({col}, {rx}, {group}) END"


def first_match(col: str, pattern: str, group: int = 1) -> Column:
    return F.expr(first_match_sql(col, pattern, group))


def sampleid_sqls(col: str = "COMMENTS") -> dict[str, str]:
    return {"SAMPLEID": first_match_sql(col, SAMPLEID_PATTERN), "SAMPLEID2": first_match_sql(col, LAB_ID_PATTERN)}


def extract_sampleid(df: DataFrame, source: str = "COMMENTS") -> DataFrame:
    """Add ``SAMPLEID`` and ``SAMPLEID2`` parsed from the comment text."""
    return df.withColumns({name: F.expr(sql) for name, sql in sampleid_sqls(source).items()})


def extract_labels(df: DataFrame, source: str, labels: Mapping[str, str]) -> DataFrame:
    """Add one column per ``{name: pattern}``: first capture group or NULL."""
    return df.withColumns({name: first_match(source, rx) for name, rx in labels.items()})


def redact_labelled_sql(col: str, label: str, stop_chars: str = ";", mask: str = "****") -> str:
    """Mask every value that follows ``label`` up to a stop character.

    ``label`` is a regex matched case-insensitively; all occurrences are
    replaced and the label itself is kept: ``PWD=secret;`` -> ``PWD=****;``.
    """
    stop = "".join("\\" + ch if ch in "[]\\^-&" else ch for ch in stop_chars)
    pattern = quote(f"(?i)({label})[^{stop}]*")
    replacement = quote("$1" + mask.replace("\\", "\\\\").replace("$", "\\$"))
    return f"regexp_replace({col}, {pattern}, {replacement})"


def redact_labelled(col: str, label: str, stop_chars: str = ";", mask: str = "****") -> Column:
    return F.expr(redact_labelled_sql(col, label, stop_chars, mask))


def redact_dsn_password(col: str) -> Column:
    return redact_labelled(col, DSN_PASSWORD_LABEL, ";")


def plain_collation(collation: str | None) -> bool:
    """Whether strings equal under ``collation`` have equal keys that are plain strings."""
    return collation is None or re.fullmatch(r"UTF8_(BINARY|LCASE)(_RTRIM)?", collation) is not None


def collation_key_sql(expr: str, collation: str | None) -> str:
    """What two strings that are equal under ``collation`` have in common.

    A plain string for the UTF8 collations, made once for each side of a join, so
    that it hashes, sorts and filters like any other key; for all others the
    collated string itself, of which Spark derives such a key.
    """
    if collation is None:
        return expr
    if not plain_collation(collation):
        return f"collate({expr}, {quote(collation)})"
    if collation.endswith("_RTRIM"):
        expr = f"rtrim({expr})"
    return f"lower({expr})" if "LCASE" in collation else expr


def slug_sql(col: str, separator: str = "_") -> str:
    """File-name slug: accented Latin letters become ASCII, a comma between
    digits is dropped, each run of other characters than ASCII letters and
    digits becomes one ``separator``, separators at either end are dropped,
    case is kept. ``TRIAL-001`` -> ``TRIAL_001``; ``***`` -> ``''``.
    """
    sep_re = "".join(ch if ch.isalnum() else "\\" + ch for ch in separator)
    sep_out = separator.replace("\\", "\\\\").replace("$", "\\$")
    text = f"translate({col}, {quote(LATIN_FROM)}, {quote(LATIN_TO)})"
    for src, dst in LATIN_PAIRS.items():
        text = f"replace({text}, {quote(src)}, {quote(dst)})"
    text = f"regexp_replace({text}, {quote(DIGIT_COMMA)}, '')"
    runs = f"regexp_replace({text}, {quote('[^A-Za-z0-9]+')}, {quote(sep_out)})"
    return f"regexp_replace({runs}, {quote(f'^(?:{sep_re})+|(?:{sep_re})+$')}, '')"


def slug(col: str, separator: str = "_") -> Column:
    return F.expr(slug_sql(col, separator))
