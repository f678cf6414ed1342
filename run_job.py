"""Launcher of the recommender jobs: ``spark-submit run_job.py --data_dir DIR --task 1``."""

import os
import sys

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# the Python workers of a local session find the package wherever the job was started
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from encore.plans.jobs import run  # noqa: E402

if __name__ == "__main__":
    run(sys.argv[1:])
