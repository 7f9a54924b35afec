import pytest

from snapfeed.scratch import scratch_dir


class Session:
    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_the_shared_folder_is_used():
    session = Session(spark_checkpoint_dir="hdfs://shared/x/", spark_master="yarn")
    assert scratch_dir(session, "pages").startswith("hdfs://shared/x/pages-")
    assert scratch_dir(session, "pages") != scratch_dir(session, "pages")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(spark_master="yarn"), "pages")
    assert "snapfeed-" in scratch_dir(Session(spark_master="local[2]"), "pages")
