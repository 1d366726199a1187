import json

import pytest

from examflow import __main__ as command
from examflow.functions import text as T
from examflow.sources import readers


def test_trees_to_questions_and_markdown(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tree = {"kids": [{"type": "heading", "heading level": 1, "content": "제목"}, {"type": "list", "list items": [{"content": "1. 가"}, {"content": "2. 나"}]}]}
    for n in "ab":
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps(tree))
    command.run(spark, ["trees", str(tmp_path / "in"), str(tmp_path / "q"), "--start", "2"])
    assert [r.question_number for r in spark.read.parquet(str(tmp_path / "q")).collect()] == [2, 2]
    command.run(spark, ["markdown", str(tmp_path / "in"), str(tmp_path / "m"), "--format", "json"])
    assert {r.markdown.split("\n")[0] for r in spark.read.json(str(tmp_path / "m")).collect()} == {"# 제목"}
    with pytest.raises(Exception, match="exist"):
        command.run(spark, ["trees", str(tmp_path / "in"), str(tmp_path / "q"), "--keep"])


def test_refused_arguments(spark, tmp_path):
    for argv in (["words", "a", "b"], ["trees", "a", "b", "--start", "0"], ["trees", "a"]):
        with pytest.raises(SystemExit):
            command.arguments(argv)
    with pytest.raises(NotADirectoryError):
        command.run(spark, ["lines", str(tmp_path / "none"), str(tmp_path / "out")])
    (tmp_path / "file").write_text("x")
    with pytest.raises(NotADirectoryError):
        readers.require_folder(spark, str(tmp_path / "file"))
    assert readers.require_folder(spark, str(tmp_path)) == str(tmp_path)


def test_padded(spark):
    from pyspark.sql import functions as F

    assert [r[0] for r in spark.createDataFrame([(7,), (1234,)], "n int").select(T.padded(F.col("n"), 3)).collect()] == ["007", "1234"]
