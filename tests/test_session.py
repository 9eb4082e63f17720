"""The checkpoint folder: taken from the session; a temp folder only for a local master."""
import os
import subprocess
import sys

import pytest

from dirlens import session


def test_unset_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_entry_and_market_run_without_the_setting(tmp_path):
    code = ("import __spark_entry__ as E; from dirlens.session import get_spark; "
            "s = get_spark('local[2]', shuffle_partitions=4); assert not s.sparkContext.getCheckpointDir(); "
            "print('ROWS', E.entry(s).count(), E.queries()['m06_market_categories'](s, E.SMOKE_DIR).count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)},   # no preset folder
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert "ROWS 1 " in out.stdout, out.stderr[-2000:]
