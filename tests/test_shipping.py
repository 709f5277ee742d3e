"""Task functions must work on executors that do not have this package."""

import subprocess
import sys

from pyspark.cloudpickle import cloudpickle

import costwatch  # noqa: F401
from costwatch.operators import blocks


def test_task_functions_travel_by_value(tmp_path):
    path = tmp_path / "function.pkl"
    path.write_bytes(cloudpickle.dumps(blocks._take_best))
    code = (
        "import pickle, sys, numpy as np\n"
        f"f = pickle.load(open({str(path)!r}, 'rb'))\n"
        "assert list(f(np.array([1.0, 3.0, 3.0]), 2, -np.inf)) == [1, 2]\n"
        "assert 'costwatch' not in sys.modules\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)
