import json

from pyspark.sql import functions as F

from shiftloom import sql
from shiftloom.functions import draws
from shiftloom.sources.completion import CompletionClient, said
from shiftloom.tools.registry import default_registry
from shiftloom.tools.trainer import TrainerTool


def test_functions_and_views_from_sql(spark):
    names = sql.register(spark, "/root/testdata/sf0.001", ("documents", "part"), default_registry())
    assert {"draw", "split_turns", "call_tool", "documents"} <= set(names)
    a = spark.sql("SELECT doc_id, draw('7', 'sample', string(doc_id)) AS u FROM documents")
    b = spark.table("documents").select("doc_id", draws.u(7, "sample", F.col("doc_id")).alias("u"))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()
    r = spark.sql("SELECT clean_text('　 NaN ') c, clean_text('\\tx ') x, mixture('A..B') m, strip_atom_maps('[CH3:12]') s, answer_rank(array('a', 'a', 'b'), 'b') k, match_reward(NULL, 0.5D) z").first()
    assert (r.c, r.x, r.m, r.s, r.k, r.z) == ("", "x", ["A", "B"], "[CH3]", 2, 0.0)
    turns = spark.sql("""SELECT role FROM split_turns('<tool_call>{}</tool_call> ok {"smiles": ["C"]}')""").collect()
    assert [t.role for t in turns] == ["assistant", "tool", "assistant"]
    assert spark.sql("SELECT status FROM call_tool('web_search', '{\"query\": \"x\"}')").first().status == "unavailable"


def test_completion_client_without_endpoint(spark):
    c = CompletionClient(None)
    assert not c.available and c.complete_many(["a", "b"]) == [None, None] and c.counters == {"requests": 2, "failures": 2}
    assert c.stage(spark.createDataFrame([("p",)], "prompt string"), "prompt").first().rewrite is None
    assert said({"data": {"choices": [{"message": {"content": "x"}}]}}) == "x"


def test_trainer_tool():
    tool = TrainerTool(default_registry(), "web_search")
    i = tool.create(create_kwargs=None)
    text, reward, metrics = tool.execute(i, '{"query": "x"}')
    assert json.loads(text)["status"] == "unavailable" and reward == 0.0 == tool.score(i) and metrics["completion"] == "failure"
    assert tool.execute(i, "bad")[2]["status"] == "error" and tool.schema["function"]["name"] == "web_search"
    tool.release(i)
