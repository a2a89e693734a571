"""``python -m cartwise {prepare,reports,run} ...`` — the job's command line."""

from .plans.job import main

if __name__ == "__main__":
    main()
