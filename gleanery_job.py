"""spark-submit entry point of the on-disk job; see gleanery/plans/job.py."""

from gleanery.plans.job import main

if __name__ == "__main__":
    main()
