"""Entry point for spark-submit: ``spark-submit --py-files quotelake.zip lake_job.py gold``."""

from quotelake.__main__ import main

if __name__ == "__main__":
    main()
