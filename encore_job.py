"""Launcher for ``spark-submit encore_job.py <load|tune|similar|stream> ...``
(the package's functions travel to executors inside task closures)."""

import sys

from encore.jobs import main

if __name__ == "__main__":
    sys.exit(main())
