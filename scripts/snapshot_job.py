"""spark-submit entry point for the one-date snapshot job.

    zip -r terrascore.zip terrascore
    spark-submit --py-files terrascore.zip scripts/snapshot_job.py \
        --date 2025-01-01 --source json --input <landing> --out <shared folder>
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrascore.plans.snapshot_job import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
