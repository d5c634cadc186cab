import json

from pyspark.sql import functions as F

from shiftloom import cli
from shiftloom.sources.remote import Service
from shiftloom.tools import results
from tests.test_operators import BASE, REVIEW, table


def test_results(spark):
    hits = spark.createDataFrame([("q", 0, "A", "u", "s", None), ("q", 1, "a", "u", "s", "c"), ("q", 2, "A", "v", None, "s")], "query string, position int, title string, url string, snippet string, content string")
    assert [r.position for r in results.distinct_hits(hits).orderBy("position").collect()] == [0, 2]
    page = results.page_hits(hits.withColumn("snippet", F.lit("<b>x</b> y")).withColumn("title", F.lit("A b/c"))).first()
    assert page.snippet == "x y" and page.url == "https://en.wikipedia.org/wiki/A_b%2Fc"
    work = results.work_rows(spark.createDataFrame([('{"title": ["T"], "issued": {"date-parts": [[2020, 1]]}, "DOI": "d"}',), ("{}",)], "item string")).collect()
    assert (work[0].title, work[0].year, work[0].doi, work[1].year) == ("T", 2020, "d", None)
    names = spark.createDataFrame([(["乙醇", "ethanol", "Ethanol ", "64-17-5", "CHEBI:16236"],), (["ethanol"],), (None,)], "s array<string>")
    got = results.classified_names(names, "s").collect()
    assert got[0].english_names == ["ethanol"] and got[0].cas_numbers == ["64-17-5"] and [r.status for r in got] == ["found", "partial", "not_found"]
    assert spark.range(1).select(results.top_candidates(F.array(F.lit(" C"), F.lit("C"), F.lit(""), F.lit("N"), F.lit("O")), 2)).first()[0] == ["C", "N"]
    assert results.resolve_names(" ", Service(None))["status"] == "invalid_smiles" and results.resolve_names("C", Service(None))["status"] == "request_failed"
    assert results.compact({"status": "ok", "request": {}, "warnings": []}) == {"status": "ok"}
    papers = spark.createDataFrame([("x" * 900, list("abcdefg"))], "abstract string, authors array<string>")
    assert results.paper_rows(papers).first().abstract == "x" * 700 + "..." and len(results.paper_rows(papers).first().authors) == 5


def test_requests_and_answers():
    from shiftloom.tools import answers as an

    ask = lambda name, **a: an.SHAPES[name].ask(a)
    assert ask("nmr_generate")[1] is None and ask("nmr_generate", h_shifts=[1.2, "x"], h_split=["t"], formula="C2H6O")[1]["nmr_type"] == "HF"
    assert ask("nmr_generate", c_nmr_peaks=[{"delta": "58"}, {"delta": "bad"}])[1]["spec_list"][0]["c_nmr_peaks"] == [{"delta (ppm)": 58.0, "delta": 58.0}]
    assert an.read_generate({"data": {"sequences": [["OCC", "CCO", "CN"]], "scores": [0.9, 0.8, 0.1]}}, {}) == [{"rank": 1, "smiles": "CCO", "canonical_smiles": "CCO", "score": 0.9, "formula": "C2H6O"}, {"rank": 2, "smiles": "CN", "canonical_smiles": "CN", "score": 0.1, "formula": "CH5N"}]
    assert ask("nmr_rerank", smiles_list=["CCO", "OCC", "CCN"], formula="C2H6O")[1]["entries"][0]["smiles_list"] == ["CCO"] and ask("nmr_rerank", smiles_list=["CCN"], formula="C2H6O")[1:] == (None, ["formula filter: 0/1 candidates have C2H6O"])
    assert [r["smiles"] for r in an.read_rerank({"entries": [{"ranking": [{"smiles": "CCO", "h_cost": 1}, {"smiles": "CCN"}, {"smiles": "OCC"}]}]}, {"smiles_list": [], "formula": "C2H6O"})] == ["CCO"]
    assert ask("nmr_repair", smiles="CCO")[1] is None and ask("nmrexp_search", h_shifts=[1.0], sigma_h=0.3)[1]["config"]["sigma_h"] == 0.3
    got = an.read_products([{"outcome": {"smiles": "CCO"}, "rank": 1, "score": 2.0}, {"outcome": "OCC", "rank": 2}, {"deep": {"products": ["CCN"], "scores": [1.0]}}], {"formula": "C2H6O"})
    assert [r["canonical_smiles"] for r in got] == ["CCO", "CCN"] and got[0]["formula_match"] and got[0]["confidence"] == "high" and got[1]["score"] < 0.1
    assert an.read_products({"products": ["CCO", "CC"]}, {})[1]["score"] == 0.5 and ask("askcos_reaction_forward_predict", reactants=["CC", "?"], backend="Graph2Smiles")[1:] == ({"reactants": "CC", "reagents": "", "solvent": "", "backend": "graph2smiles", "top": 10}, ["unreadable: ?"])
    assert [h["rank"] for h in an.read_web([{"a": [{"title": "x", "url": "u"}, {"Title": "x", "link": "u"}, {"title": "y"}]}], {})] == [1, 2]
    assert an.read_wikipedia({"query": {"search": [{"title": "A b", "snippet": "<b>s</b>"}]}}, {})[0]["url"].endswith("A_b") and an.read_works({"message": {"items": [{"title": ["T"], "issued": {"date-parts": [[2020]]}}]}}, {})[0]["year"] == 2020
    assert an.read_code({"stdout": 'x {"a": 1}', "returncode": 0}, {}) == {"stdout": 'x {"a": 1}', "stderr": "", "return_code": 0, "last_json": {"a": 1}} and ask("code_interpreter", code="```py\nprint(1)\n```")[1]["code"] == "print(1)"


def test_cli_from_export_to_artifacts(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    p = lambda n: str(tmp_path / n)
    said = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    rows = [BASE | REVIEW | {"SMILES": s, "smiles_actual": s} for s in ("CCO", "CCCO", "c1ccccc1C", "c1ccccc1N", "CCO", "")]
    table(spark, rows).drop("row_index", "source_ord").coalesce(1).write.parquet(p("a.parquet"))
    args = ["preprocess", "--source", p("a.parquet"), "--out", p("records.parquet")]
    cli.main(args)
    first = said()
    assert first["status"] == "built" and first["kept"] == 5 and first["dropped_empty"] == 1
    cli.main(args)
    assert said()["status"] == "cached"
    cli.main(["info", p("records.parquet")])
    assert said()["rows"] == 4
    cli.main(["cluster", p("records.parquet"), "--k", "2", "--bits", "256"])
    assert sum(said().values()) == 4 and spark.read.parquet(p("records.parquet")).where("cluster is null").count() == 0
    records = spark.read.parquet(p("records.parquet")).select(
        "sample_id", "gt_smiles", F.transform("nmr_list", lambda b: F.struct(b["type"].alias("type"), b["frequency"].alias("frequency"), b["solvent"].alias("solvent"), b["shift_text"].alias("shift_text"))).alias("spectra"),
        F.lit("C2H6O").alias("formula"), F.struct(F.lit(None).cast("string").alias("chinese"), F.lit("x").alias("english")).alias("names")
    )
    records.write.parquet(p("plan.parquet"))
    cli.main(["augment", p("plan.parquet"), p("samples.parquet")])
    assert said()["rows"] == 4
    cli.main(["compile", p("samples.parquet"), p("out.jsonl"), "--tools", "web_search"])
    assert said()["rows"] == 4
    cli.main(["write-config", p("tools.yaml"), "--tools", "web_search"])
    assert "web_search" in open(p("tools.yaml")).read()
    cli.main(["run", "head_n", "/root/testdata/sf0.001", "--out", p("head.parquet")])
    assert said()["rows"] == 25
