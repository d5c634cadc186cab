import json
import os

import pytest
from pyspark.sql import functions as F

from shiftloom.chem import backend
from shiftloom.functions import transcript as tr
from shiftloom.functions.schema_check import problems
from shiftloom.plans import augment, reward
from shiftloom.plans import compile as artifacts
from shiftloom.sources import remote, sinks, tables
from shiftloom.streaming import replay
from shiftloom.tools.registry import Tool, default_registry, result
from shiftloom.tools.search import LocalSearch

SCHEMA = {"type": "function", "function": {"name": "look", "parameters": {"type": "object", "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}}, "required": ["q"], "additionalProperties": False}}}
EQUAL = {p: 0.25 for p in reward.PARTS}


def call(body):
    return f"<tool_call>{body}</tool_call>"


def answer(*s):
    return json.dumps({"smiles": list(s)})


# --- rewards ---------------------------------------------------------------------------------------


def test_rank_discount():
    got = reward.evaluate(answer("CCC", "CCO"), "CCO", o=reward.RewardOptions(discount=0.5))
    assert got["components"]["gt_smiles"] == 0.5 and got["score"] == pytest.approx(0.35) and got["rank"] == 2


def test_call_penalties():
    text = call('{"name": "look", "arguments": {"q": "x"}}') + call('{"name": "other", "arguments": {}}') + call("not json") + answer("CCC", "CCO")
    o = reward.RewardOptions(discount=0.5, max_calls=1, excess_call=-0.2, weights=EQUAL)
    got = reward.evaluate(text, {"gt_smiles": "CCO"}, [SCHEMA], o)
    assert got["components"] == {"gt_smiles": 0.5, "tool_call_format": -2.0, "smiles_validity": 0.0, "tool_call_count": -0.4} and got["score"] == pytest.approx(-0.475)


def test_two_errors_are_one_bad_call():
    got = reward.evaluate([{"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "look", "arguments": '{"n": 0, "z": 1}'}}]}, {"role": "assistant", "content": answer("CCO")}], "CCO", [SCHEMA])
    assert got["bad_calls"] == 1 and len(got["errors"]) >= 2 and got["rank"] == 1


def test_answers_only_after_the_last_call():
    payload = '{"completion": "success", "status": "ok", "data": {"smiles": ["CCC"]}}'
    assert reward.evaluate(call('{"name": "look", "arguments": {"q": "x"}}') + payload + "\n" + answer("CCO"), "CCO")["rank"] == 1
    assert reward.evaluate(answer("CCO") + call('{"name": "look", "arguments": {"q": "x"}}') + payload, "CCO")["rank"] is None
    assert reward.evaluate("the answer is CCO", "CCO")["rank"] is None
    lenient = reward.RewardOptions(strict=False)
    assert [reward.evaluate(t, "CCO", o=lenient)["rank"] for t in ("SMILES: CCO", "rank 1: CCO", "1. CCC\n2) CCO", "<smiles>CCC, CCO</smiles>", "CCO", "it may be CCO")] == [1, 1, 2, 2, 1, 1]
    assert reward.free_answers('{"smiles_list": ["A", {"canonical_smiles": "B"}]}') == ["A", "B"] and reward.free_answers('```json\n{"candidates": "C"}\n```\nsmiles: D') == ["C", "D"]


def test_validity_penalty_counts_once():
    got = reward.evaluate(answer("xx", "C1CC", "CCO"), "CCO", chem=backend.get("graph"))
    assert got["components"]["smiles_validity"] == -1.0 and got["rank"] == 1 and got["invalid"] == ["xx", "C1CC"]


def test_adapters_and_options():
    assert [r["score"] for r in reward.compute_scores([answer("CCO"), "no"], ["CCO", "CCO"], options=reward.RewardOptions(weights={"gt_smiles": 1.0, **{p: 0.0 for p in reward.PARTS[1:]}}))] == [1.0, 0.0]
    with pytest.raises(ValueError):
        reward.compute_scores(["a"], [])
    with pytest.raises(ValueError):
        reward.RewardOptions(weights={"gt_smiles": 1.0})
    assert reward.truth_of(["CCO"]) == reward.truth_of({"smiles": ["CCO"]}) == reward.truth_of(" CCO ") == reward.truth_of('{"answer": "CCO"}') == "CCO" and reward.truth_of(None) == ""
    assert reward.truth_of({"ground_truth": "CCO", "smiles": "CCC"}) == "CCO" and reward.truth_of('["CCO"]') == '["CCO"]'


def test_transcript_grammar(spark):
    text = "dropped " + call('{"a": 1}') + " result " + call('{"b": 2}') + ' {"completion": 1, "status": 2} '
    assert [t["role"] for t in tr.split_turns(text)] == ["assistant", "tool", "assistant", "tool"]
    assert tr.ranked_answers('```json\n{"smiles": "CCO"}\n```') == ["CCO"] and tr.ranked_answers('{"smiles": [{"canonical_smiles": "CC"}, " ", 3]}') == ["CC"]
    assert tr.last_json('a {"x": 1} b [2, 3] c') == "[2, 3]" and tr.last_json("none here") is None
    assert [s["kind"] for s in tr.segments("hi <tool_call>{}</tool_call><tool_response>x</tool_response> bye")] == ["text", "tool_call", "tool_response", "text"]
    df = spark.createDataFrame([(text + answer("A", "B"),)], "t string")
    assert df.select(tr.answer_list(F.col("t"))).first()[0] == ["A", "B"] and df.select(tr.orphan_calls(F.concat("t", F.lit("<tool_call>")))).first()[0] == 1


def test_schema_subset():
    s = {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "number", "maximum": 3}}, "b": {"enum": ["x"]}}, "required": ["c"], "additionalProperties": False}
    assert set(problems({"a": [1, 5, True], "b": "y", "d": 1}, s)) == {"arguments.c is missing", "arguments.d is not a parameter", "arguments.a[1] is above 3", "arguments.a[2] is of type boolean, not number", "arguments.b is none of ['x']"}


# --- artifacts and samples -------------------------------------------------------------------------

TURNS = "array<struct<role:string,content:string>>"


def test_compile(spark, tmp_path):
    rows = [("s1", "o1", " CCO ", [("user", "u1"), ("assistant", "a"), ("user", "u2")]), ("s2", "o2", "", [("user", "x")])]
    df = spark.createDataFrame(rows, f"sample_id string, source_sample_id string, gt_smiles string, turns {TURNS}")
    o = artifacts.ArtifactOptions(tool_names=("look",), reward_config={"discount": 0.5})
    r = artifacts.compile_samples(df.limit(1), "train", o).first()
    assert [p.role for p in r.prompt] == ["system", "user", "user"] and len(r.raw_prompt) == 2 and r.reward_model.ground_truth == "CCO" and r.extra_info.interaction_kwargs.followup_turns == ["u2"]
    assert r.extra_info.tools_kwargs["look"].create_kwargs is None and json.loads(r.extra_info.reward_config) == {"discount": 0.5}
    with pytest.raises(Exception, match="no ground truth"):
        artifacts.compile_samples(df, "train", o).collect()
    out = artifacts.compile_samples(df, "train", o, on_error="drop")
    assert sinks.write_as(out, str(tmp_path / "a.parquet")) == 1 == sinks.write_as(out, str(tmp_path / "a.jsonl"))
    assert spark.read.parquet(str(tmp_path / "a.parquet")).first().extra_info.tools_kwargs["look"].create_kwargs is None
    with pytest.raises(ValueError):
        sinks.write_as(out, "a.txt")


def records(spark, n=60, **over):
    block = [("1H NMR", "400 MHz", "CDCl3", "3.70 (q, 2H), 1.20 (t, 3H)"), ("13C NMR", None, None, "58.0, 18.1")]
    item = lambda parts, template=None, verified=None: (parts, "K2CO3", "Williamson", template, verified)
    row = {"formula": "C2H6O", "names": ("乙醇", "ethanol"), "precedents": [item(["CC=O", "C"])], "routes": [item(["R"], "a", False), item(["S"], "b", True)], "fragments": [("alcohol", "醇羟基"), ("murcko_scaffold", "x"), ("y", "")], "polymer": [("二元醇", "缩聚")]} | over
    rows = [(f"r{i}", "CCO", block, *(row[k] for k in ("formula", "names", "precedents", "routes", "fragments", "polymer"))) for i in range(n)]
    kinds = ", ".join(f"{k} {augment.FACTS[k]}" for k in ("formula", "names", "precedents", "routes", "fragments", "polymer"))
    return spark.createDataFrame(rows, f"sample_id string, gt_smiles string, spectra array<struct<type:string,frequency:string,solvent:string,shift_text:string>>, {kinds}")


def mix(**w):
    return {k: w.get(k, 0.0) for k in augment.INFORMATION}


def built(spark, o, n=60, **over):
    return augment.assemble(augment.plan_samples(records(spark, n, **over), o), o)


def test_samples_by_mix_and_placement(spark):
    o = augment.AugmentOptions(mix=mix(formula=1.0), followup=0.0, modality_drop=0.0)
    assert all(len(r.turns) == 1 and "C2H6O" in r.turns[0].content and "3.70 (q, 2H)" in r.turns[0].content for r in built(spark, o).collect())
    o = augment.AugmentOptions(mix=mix(formula=1.0), followup=1.0, modality_drop=1.0)
    got = built(spark, o).collect()
    assert all(len(r.turns) == r.num_of_queries == 2 and "C2H6O" in r.turns[1].content and "C2H6O" not in r.turns[0].content for r in got)
    assert all(r.augmentation.num_active_modalities == 1 and len(r.nmr_list) == 2 and len(r.augmentation.dropped_modalities) == 1 for r in got) and len(got[0].asDict()) == 19
    summary = augment.build_summary(built(spark, augment.AugmentOptions(mix=mix(formula=1.0)), 5, formula=None)).first()
    assert summary.information_degraded == 5 and summary.multi_turn == 0 and summary.information_types == {"none": 5} and summary.requested_information_types == {"formula": 5} and summary.noised == {}


def test_information_of_reactions_and_fragments(spark):
    o = augment.AugmentOptions(mix=mix(reaction=1.0), followup=0.0, uncertain=0.0)
    got = built(spark, o).collect()
    assert all("原料：CC=O、C，条件：K2CO3，反应类型：Williamson" in r.turns[0].content and "化合物合成信息如下" in r.turns[0].content and not r.augmentation.uncertain_tone for r in got)
    assert any("二元醇（缩聚）" in r.turns[0].content for r in got) and any("二元醇" not in r.turns[0].content for r in got)
    routes = built(spark, o, precedents=None).collect()
    assert all("原料：S" in r.turns[0].content and r.augmentation.uncertain_tone and r.augmentation.num_retro_routes == 2 and r.augmentation.askcos_verified and not r.augmentation.has_reaction_precedent for r in routes)
    assert all("醇羟基" in r.turns[0].content for r in built(spark, augment.AugmentOptions(mix=mix(fragment=1.0), followup=0.0)).collect())


def test_rewrites_must_keep_the_spectrum(spark):
    o = augment.AugmentOptions(mix=mix(formula=1.0), modality_drop=0.0, followup=1.0)
    planned = augment.plan_samples(records(spark, 3), o)
    text = planned.orderBy("sample_id").first().spectrum_text
    rewrites = spark.createDataFrame([("r0", 0, f"Dear all, {text} please"), ("r0", 1, "and C2H6O"), ("r1", 0, "lost it"), ("r1", 1, "C2H6O")], "sample_id string, slot int, text string")
    got = {r.source_sample_id: r for r in augment.assemble(augment.attach_rewrites(planned, rewrites), o).collect()}
    assert [got[k].augmentation.llm_status for k in ("r0", "r1", "r2")] == ["llm", "mixed", "template"] and got["r0"].turns[0].content.startswith("Dear all") and got["r1"].turns[1].content == "C2H6O"


def test_samples_are_repeatable_and_noise_changes_text(spark):
    o = augment.AugmentOptions(noise=1.0, strength=1.0, modes=("digits_only",), modality_drop=0.0, seed=4)
    a = augment.plan_samples(records(spark), o).orderBy("sample_id")
    assert a.select("spectrum_text", "information").collect() == augment.plan_samples(records(spark).repartition(7), o).orderBy("sample_id").select("spectrum_text", "information").collect()
    assert all(r.noise_changed and r.spectrum_text.startswith("3.70 2 1.20 3") for r in a.collect())
    with pytest.raises(ValueError):
        augment.AugmentOptions(mix=mix(formula=0.5))
    with pytest.raises(ValueError):
        augment.AugmentOptions(reaction_noise=0.1)


# --- streams, sources, tools, structures -----------------------------------------------------------


def test_scripted_followup_and_streams(spark, tmp_path):
    f = replay.ScriptedFollowup()
    f.start("i", ["a", " ", "b"])
    assert [f.generate("i") for _ in range(3)] == [(False, "a"), (False, "b"), (True, "")]
    f.finalize("i")
    assert f.generate("i") == (True, "")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"tool": "t", "failed": x}) for x in (True, True, True, False)))
    stream = spark.readStream.schema("tool string, failed boolean").json(str(tmp_path / "in"))
    q = replay.failure_stream(stream).writeStream.format("memory").queryName("streaks").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.streak, r.warn, r.recovered) for r in spark.table("streaks").collect()) == [(0, False, True), (1, False, False), (2, False, False), (3, True, False)]


def test_replay_batch_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([("i", ["a", " ", "b"]), ("j", None)], "instance string, turns array<string>")
    got = sorted((r.instance, r.step, r.content, r.done) for r in replay.replay(rows, "instance", "turns").collect())
    assert got == [("i", 0, "a", False), ("i", 1, "b", False), ("i", 2, "", True), ("j", 0, "", True)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"instance": "i", "turns": t}) for t in (["a", " "], None, None)))
    stream = spark.readStream.schema("instance string, turns array<string>").json(str(tmp_path / "in"))
    q = replay.replay_stream(stream).writeStream.format("memory").queryName("replayed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.content, r.done) for r in spark.table("replayed").collect()) == [("", True), ("", True), ("a", False)]


def test_sources(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    (tmp_path / "a.csv").write_bytes("name,v\n乙醇,NA\nx,\"a\nb\"\n".encode("gb18030"))
    got = tables.export(spark, p("a.csv")).orderBy("row_index").collect()
    assert [(r.name, r.v, r.row_index) for r in got] == [("乙醇", None, 0), ("x", "a\nb", 1)]
    (tmp_path / "l.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    assert [r.id for r in tables.jsonl(spark, p("l.jsonl"), "id long").collect()] == [1, 2] == [r.id for r in tables.strict_jsonl(spark, p("l.jsonl"), "id long").collect()]
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\nnope\n{"id": 1, "v": "last"}\n')
    with pytest.raises(Exception, match="bad.jsonl:2"):
        tables.strict_jsonl(spark, p("bad.jsonl"), "id long").collect()
    assert [r.v for r in tables.tolerant_cache(spark, p("bad.jsonl"), "id long, v string", "id").collect()] == ["last"]
    (tmp_path / "r.csv").write_text("reactant,product\nCC.O,CCO\n")
    (tmp_path / "r.txt").write_text("[CH3:1]C>O>CCO |x|\tref\t-\t1.1\tname\nbroken\n")
    a, b = tables.reactions_csv(spark, p("r.csv")).first(), tables.reactions_text(spark, p("r.txt")).first()
    assert a.reactants == ["CC", "O"] and b.reactants == ["[CH3]C"] and b.agents == ["O"] and b.products == ["CCO"] and (b.reference, b.class_name) == ("ref", "name")
    (tmp_path / "odd.csv").write_bytes("name\n".encode() + b"a\xff\xff\n" + "é\n".encode())
    assert tables.encoding_of(spark, p("odd.csv")) == "UTF-8" and [r.name for r in tables.export(spark, p("odd.csv")).orderBy("row_index").collect()][1] == "é"
    (tmp_path / "many").mkdir()
    for k in range(3):
        (tmp_path / "many" / f"f{k}.txt").write_text("\n".join(f"{k}-{i}" for i in range(40)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    many = tables.numbered(spark.read.text(p("many")), "n").orderBy("n").collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.n, r.value) for r in many] == [(40 * k + i, f"{k}-{i}") for k in range(3) for i in range(40)]
    spark.createDataFrame([("see CC.O>>CCO, ok",)], "text string").write.parquet(p("e"))
    assert tables.reactions_embedded(spark, p("e")).first().products == ["CCO"]
    os.makedirs(p("logs/run1"))
    (tmp_path / "logs" / "run1" / "x.jsonl").write_text('{"input": "i", "score": 0.5}\nbad\n')
    assert [(r.run, r.score) for r in tables.trajectories(spark, p("logs"), artifacts.TRAJECTORY).collect()] == [("run1", 0.5)]
    built = []
    for force in (False, False, True):
        df = tables.load_or_build(spark, p("cache"), lambda: built.append(1) or spark.range(3), force)
        assert df.count() == 3
    assert len(built) == 2
    sinks.append_cache(spark.range(1).toDF("id"), p("cache"))
    assert spark.read.parquet(p("cache")).count() == 4
    assert "a:\n  - 1\n" in sinks.yaml_text({"a": [1]}) and json.loads(sinks.manifest({"train": 2}, {}))["rows"] == 2


def test_remote_calls(spark):
    assert remote.Service(None).call({})["status"] == "unavailable"
    assert remote.Service("http://127.0.0.1:9/", timeout=1, retries=0).call({})["status"] == "error"
    assert remote.events(': c\ndata: {"a": 1}\nevent: x\ndata: bad\ndata: [DONE]\ndata: {"a": 2}') == [{"a": 1}]
    assert remote.candidate_list({"data": {"results": [1]}}) == [1] and remote.candidate_list({}) == []
    assert [x["smiles"] for x in remote.nested_items({"a": [{"smiles": 1}, {"b": {"smiles": 2}}]}, "smiles")] == [1, 2]
    out = remote.fan_out(spark.range(5), lambda r: {"n": r["id"] * 2}, ["id"]).orderBy("id").collect()
    assert [json.loads(r.answer)["n"] for r in out] == [0, 2, 4, 6, 8]


def test_registry_and_local_search(spark):
    rows = [(0, 0, ["CC", "O"], ["CCO"]), (1, 0, ["CC", "N"], ["CCN"]), (2, 0, ["X"], [])]
    search = LocalSearch(spark.createDataFrame(rows, "record long, source_ord int, reactants array<string>, products array<string>"))
    r = default_registry(search=search)
    assert len(r.names) == 13 and r.names[0] == "reaction_local_index_search" and len(r.schemas(["web_search"])) == 1
    got = r.invoke("reaction_local_index_search", {"reaction": "CC.O>>", "formula": "C2H6O"})
    assert [c["product"] for c in got["data"]["candidates"]] == ["CCO", "CCN"] and got["data"]["candidates"][0]["formula_match"] and not got["data"]["candidates"][1]["formula_match"] and got["warnings"]
    none = LocalSearch(spark.createDataFrame([(0, 0, ["CC", "O"], ["CCN"]), (1, 0, ["CC", "N"], ["CCO"])], "record long, source_ord int, reactants array<string>, products array<string>"))
    best = none({"reactants": ["CC", "O", "N"], "formula": "C2H6O", "hints": ["alcohol"], "top": 1})["data"]["candidates"]
    assert [c["product"] for c in best] == ["CCO"] and best[0]["missing_hints"] == []  # evidence counts before the cut
    assert r.invoke("web_search", '{"query": "x"}')["status"] == "unavailable" and r.invoke("web_search", "[1]")["status"] == "error"
    r.streaks.clear()
    assert r.invoke("web_search", {"query": "x"})["status"] == "unavailable" and r.invoke("web_search", {})["status"] == "error"
    assert any("3 times" in w for w in r.invoke("web_search", {"query": "x"})["warnings"]) and r.invoke("nope", {})["status"] == "error"
    with pytest.raises(ValueError):
        r.register(Tool("web_search", "", {}, lambda a: result("success", "ok")))
    r.register(Tool("web_search", "", {}, lambda a: result("success", "ok")), replace=True)
    assert any("again" in w for w in r.invoke("web_search", {})["warnings"])


def test_structures(spark):
    g = backend.get("graph")
    assert g.properties("CC(=O)Oc1ccccc1C(=O)O") | {"canonical_smiles": ""} == {"canonical_smiles": "", "scaffold": "c1ccccc1", "molecular_formula": "C9H8O4", "molecular_weight": 180.159, "exact_mass": 180.0423, "heavy_atoms": 13, "rings": 1, "aromatic_rings": 1}
    assert g.formula("C[N+](C)(C)C") == "C4H12N+" and g.strict("C1CC") is None and g.canonical(" xyz ") == "xyz" and g.canonical("OCC") == "CCO"
    keys = [f["key"] for f in g.fragments("NC(=O)c1ccncc1")]
    assert {"amide", "pyridine"} <= set(keys) and keys[-1] == "murcko_scaffold" and g.fragments("bad!") == []
    assert {"steroid_skeleton", "tetracyclic_terpenoid"} <= {f["key"] for f in g.fragments("CC12CCC3C(CCC4CC(O)CCC34C)C1CCC2O", 20)} and g.fragments("CCO", 0) == []
    assert [f["count"] for f in g.fragments("OCC1OC(OC)C(O)C(O)C1O", 20) if f["key"] in ("pyranose", "glycoside")] == [1, 1]
    assert [m["key"] for m in g.motifs("OCCO")] == ["diol"] and g.motifs("CCO") == [] and [m["key"] for m in g.motifs("C=Cc1ccccc1")] == ["styrene"]
    assert g.hints_met("CCO", ["an alcohol", "a nitrile", "odd"]) == (1, ["a nitrile", "odd"]) and g.hints_met("c1ccccc1", ["phenyl", "Aromatic ring"]) == (2, [])
    assert g.strict("C1=CC=CC=C1O") == g.strict("Oc1ccccc1") and g.strict("C[C@H](N)O") == "C[C@H](N)O" and g.flat("C[C@H](N)O") == g.flat("OC(C)N")
    assert g.agents(["ClCCl", "OCC", "ClCCl", "XX"]) == ["二氯甲烷", "乙醇", "XX"] and g.holds("OCCO", "[OX2H]", 2) and not g.holds("CCO", "[OX2H]", 2)
    found = {(r["template"], tuple(r["reactants"])) for r in g.routes("CC(=O)Oc1ccccc1C(=O)O")[0]}
    assert found == {("aryl_esterification", (g.flat("OC(=O)c1ccccc1O"), "CC(=O)O"))} and g.routes("O=C1CCCCCO1") == ([], "not_found") and g.routes("?") == ([], "invalid_smiles")
    assert [r["template"] for r in g.routes("Cc1cn(CC)nn1")[0]] == ["click_triazole"] and "CCN=[N+]=[N-]" in g.routes("Cc1cn(CC)nn1")[0][0]["reactants"]
    a, b = g.features("CCO"), g.features("CCN")
    assert a[2] and a[0] != b[0] and len(a[0]) == 256 and len(a[1]) == 9 and not g.features("??")[2]
    assert backend.components("graph", ["[CH3:1]O", "bad!"], "scan") == (["CO"], ["bad!"])
    assert backend.same_formula("graph", ["CCO", "CCN"], "C2H6O") == (["CCO"], "1/2 candidates match C2H6O")
    r = {x.s: x for x in backend.with_structure(spark.createDataFrame([("CCO",), ("??",), (None,)], "s string"), "s").collect()}
    assert r["CCO"].formula == "C2H6O" and r["??"].formula is None and r[None].canonical is None
    o = backend.get("opaque")
    assert o.strict("anything") == "anything" and o.formula("CCO") is None and o.fragments("CCO") == []


def test_each_structure_is_read_once_and_every_row_kept(spark):
    from shiftloom.chem import backend

    said = ["CCO", "CCN", "", None, "??"]
    rows = spark.createDataFrame([(i, said[i % 5]) for i in range(1000)], "i long, s string")
    out = backend.with_structure(rows, "s")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("MapInArrow") < plan.index("Aggregate [__smiles")  # distinct structures go into the reader
    got = out.collect()
    assert out.columns[:2] == ["i", "s"] and sorted((x.i, x.s) for x in got) == [(i, said[i % 5]) for i in range(1000)]
    assert {(x.s, x.formula) for x in got} == {("CCO", "C2H6O"), ("CCN", "C2H7N"), ("", None), (None, None), ("??", None)}
