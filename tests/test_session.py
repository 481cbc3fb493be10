"""How the package reaches executors."""

import types
import zipfile

from thalweg import session


def test_the_zip_is_there_when_executors_ask_for_it():
    sent = []
    context = types.SimpleNamespace(environment={}, master="spark://host:7077", applicationId="app-of-this-test", addPyFile=sent.append)
    spark = types.SimpleNamespace(sparkContext=context)
    session.ship_package(spark)
    session.ship_package(spark)
    assert len(sent) == 1
    assert "thalweg/llm/queries.py" in zipfile.ZipFile(sent[0]).namelist()
