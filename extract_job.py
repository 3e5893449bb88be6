"""spark-submit launcher: ``spark-submit --py-files vialflow.zip extract_job.py --tables ... --trial-code ...``."""

import sys

from vialflow.job import main

if __name__ == "__main__":
    main(sys.argv[1:])
