from tidemark import session


def test_unknown_profile_falls_back():
    assert session.get_profile("xyz").name == "development"
    assert session.get_profile(None).name == "development"
    assert session.get_profile("production").max_files_per_trigger == 50


def test_scratch_under_shared_root(spark):
    root = session.shared_root(spark)
    a, b = session.scratch_dir(spark, "t"), session.scratch_dir(spark, "t")
    assert a != b and a.startswith(root)


def test_a_cluster_session_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    import pytest

    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda **kw: pytest.fail("a machine-local folder"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_root(Session())
    assert session.is_local_master("local") and session.is_local_master("local[4]")


def test_scratch_is_made_by_the_file_system(spark):
    assert session.fs_exists(spark, session.scratch_dir(spark, "t"))
