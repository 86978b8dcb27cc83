"""Where the shared folder comes from."""

from types import SimpleNamespace

import pytest

from broadsheet import session


@pytest.mark.parametrize("master, own", [
    ("local", True), ("local[*]", True), ("local[8]", True), ("local[4,2]", True),
    ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://localhost:7077", False)])
def test_only_a_local_session_gets_a_folder_of_its_own(master, own, tmp_path, monkeypatch):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))
    if own:
        assert session.shared_folder(spark) == str(tmp_path) and made == [str(tmp_path)]
    else:
        with pytest.raises(ValueError):
            session.shared_folder(spark)
    assert session.shared_folder(SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda name, default: "/shared"))) == "/shared"
