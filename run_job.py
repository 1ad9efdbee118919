"""Run scheduled reports: ``spark-submit --py-files adtally.zip run_job.py JOB ... --as-of T --root DIR``."""

from adtally.jobs import main

if __name__ == "__main__":
    main()
