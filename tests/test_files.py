"""Readers, sinks, the persisted index and the stream."""

import pytest
from pyspark.sql import functions as F

from linkforge.operators import blocking as B
from linkforge.sources import index as I
from linkforge.sources import sinks as K
from linkforge.sources import tsv as S
from linkforge.streaming.incremental import link_stream

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_strictness(spark, tmp_path):
    good = put(tmp_path, "a.tsv", HEAD + 'S2-1\t Acme \t"a\tb"\tUS\nS2-2\tBeta\n')
    rows = {r.entity_id: r for r in S.read_source(spark, good).collect()}
    assert rows["S2-1"].business_name == "Acme" and rows["S2-1"].business_address == "a\tb" and rows["S2-2"].country == "" and rows["S2-2"].source == "S2"
    assert S.read_source(spark, good, "superset").where("entity_id = 'S2-1'").first().business_name == " Acme "
    with pytest.raises(Exception, match="too many"):
        S.read_source(spark, put(tmp_path, "b.tsv", HEAD + "S2-1\ta\tb\tc\td\n")).collect()
    other = put(tmp_path, "c.tsv", "x\tentity_id\n1\tS2-1\n")
    for mode in ("exact", "superset"):
        with pytest.raises(ValueError):
            S.read_source(spark, other, mode)
    assert S.read_source(spark, other, "unchecked").first().business_name == ""
    with pytest.raises(Exception, match="unexpected id"):
        S.with_prefix(S.read_source(spark, good), "S1-").collect()


def test_lists_scores_ids(spark, tmp_path):
    head = "source1_entity_id\tmatched_entity_ids\n"
    lists = S.read_lists(spark, put(tmp_path, "t.tsv", head + "S1-1\tS2-1,S3-2\nS1-2\t\n"), S.TRUTH)
    assert {tuple(r) for r in S.truth_links(lists).collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-2")} and lists.count() == 2
    for bad in ("S1-1\tS2-1,,S2-2\n", "S1-1\tS2-1,S2-1\n", "S1-1\t\nS1-1\t\n", "\tS2-1\n"):
        with pytest.raises(ValueError):
            S.read_lists(spark, put(tmp_path, "bad.tsv", head + bad), S.TRUTH)
    assert S.read_lists(spark, put(tmp_path, "last.tsv", head + "S1-1\tS2-1\nS1-1\tS2-2\n"), S.TRUTH, strict=False).first()[1] == "S2-2"
    scores = put(tmp_path, "s.tsv", "source1_entity_id\tcandidate_entity_id\tscore\nS1-1\tS2-1\t0.5\nS1-1\tS2-1\t0.7\nS1-1\tS2-2\tabc\nS1-1\tS2-3\t\n")
    assert [tuple(r) for r in S.read_scores(spark, scores).collect()] == [("S1-1", "S2-1", 0.7)]
    ids = put(tmp_path, "ids.txt", "S1-2\n\nS1-1\nS1-2\n")
    with pytest.raises(ValueError):
        S.read_ids(spark, ids)
    known = S.read_ids(spark, ids, duplicates="allow")
    assert known.count() == 2
    with pytest.raises(ValueError):
        S.read_ids(spark, put(tmp_path, "none.txt", "\n"), allow_empty=False)
    assert S.restricted(lists, known.where("entity_id = 'S1-1'")).count() == 1
    with pytest.raises(ValueError):
        S.restricted(lists.where("source1_entity_id = 'S1-1'"), known, complete=True)
    K.write_ids(known, str(tmp_path / "out_ids"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out_ids")).collect()] == ["S1-1", "S1-2"]


def test_round_trip_and_publish(spark, tmp_path):
    rows = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", "")], "source1_entity_id string, candidate_entity_ids string")
    for _ in range(2):
        K.write_tsv(rows, str(tmp_path / "lists.tsv"), single=True)
        K.write_tsv(rows, str(tmp_path / "folder"))
    part = tmp_path / "lists.tsv"
    assert part.read_text() == "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S2-2\nS1-2\t\n"
    assert S.read_lists(spark, str(part), S.CANDIDATES).count() == 2 and not list(tmp_path.glob("*.partial*"))
    # A published folder is read through its pointer; older versions are gone.
    assert S.read_lists(spark, K.current(spark, str(tmp_path / "folder")), S.CANDIDATES).count() == 2 and len(list((tmp_path / "folder").glob("v-*"))) == 1
    K.write_stats(rows.agg(F.count("*").alias("n")), str(tmp_path / "stats.json"))
    assert '"n": 2' in K.read_text(spark, str(tmp_path / "stats.json"))
    with pytest.raises(FileNotFoundError):
        S.Catalog(str(tmp_path)).validate(spark)


def test_order_of_files(spark, tmp_path):
    """Rows keep the numbers of their lines, however many tasks read them; the last of repeated rows counts."""
    ids = [f"S1-{(i * 7919) % 5000}" for i in range(5000)]
    path = put(tmp_path, "s.tsv", HEAD + "".join(f"{x}\tname {i}\taddress\tUS\n" for i, x in enumerate(ids)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = S.read_queries(spark, path)
        assert rows.rdd.getNumPartitions() > 1
        assert [r.entity_id for r in rows.orderBy("row_no").collect()] == ids and S.read_queries(spark, path, limit=7).count() == 7
        assert [r.entity_id for r in S.read_query_ids(spark, path).orderBy("row_no").collect()] == ids
        twice = put(tmp_path, "l.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i % 50}\tS2-{i}\n" for i in range(6000)))
        assert {tuple(r) for r in S.read_lists(spark, twice, S.TRUTH, strict=False).collect()} == {(f"S1-{i % 50}", f"S2-{i}") for i in range(5950, 6000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lists = put(tmp_path, "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-2\tS2-1,S1-9, S2-1 ,,S3-4\nS1-1\t\n")
    found = S.read_candidate_rows(spark, lists)
    assert {(r.query_id, tuple(r.candidates), r.row_no) for r in found.collect()} == {("S1-2", ("S2-1", "S3-4"), 0), ("S1-1", (), 1)}
    some = lambda *x: spark.createDataFrame([(a, i) for i, a in enumerate(x)], "entity_id string, row_no long")
    S.same_order(some("S1-2", "S1-1"), found)
    for wrong in (some("S1-1", "S1-2"), some("S1-2"), some("S1-2", "S1-1", "S1-3")):
        with pytest.raises(ValueError, match="order mismatch"):
            S.same_order(wrong, found)
    quoted = put(tmp_path, "q.tsv", HEAD + 'S1-1\t"two\nlines"\tx\tUS\nS1-2\tplain\ty\tUS\n')
    assert {r.business_name for r in S.read_source(spark, quoted).collect()} == {"two\nlines", "plain"} and S.spans_lines(spark, quoted) and not S.spans_lines(spark, path)
    long = put(tmp_path, "b.tsv", HEAD + "S1-1\ta\tb\tc\nS1-2\ta\tb\tc\td\n")
    assert [r.line for r in S.broken_rows(spark, long).collect()] == [3]
    known = spark.createDataFrame([("S1-1",)], "entity_id string")
    assert S.read_countries(spark, quoted, known).first().country == "US"
    with pytest.raises(ValueError, match="absent"):
        S.read_countries(spark, quoted, spark.createDataFrame([("S1-1",), ("S1-9",)], "entity_id string"))


def test_whole_runs(spark, tmp_path):
    """From tables to both output files, model and reports."""
    import json

    from linkforge.__main__ import main
    from tests.test_linkage import ROWS, candidates_of, features_of

    rows = [r for r in ROWS if r[0] != "S1-5"]
    names = {}
    for prefix, name in (("S1-", "source1"), ("S2-", "source2"), ("S3-", "source3")):
        text = HEAD + "".join("\t".join(r) + "\n" for r in reversed(rows) if r[0].startswith(prefix))
        for split in ("train", "test"):
            (tmp_path / split).mkdir(exist_ok=True)
            names[name] = put(tmp_path / split, f"{split}_{name}.tsv", text)
    truth = put(tmp_path / "train", "train_ground_truth.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\tS2-2\nS1-3\tS2-3\nS1-4\t\n")
    ids, place, out = put(tmp_path, "ids.txt", "S1-1\nS1-2\nS1-3\nS1-4\n"), str(tmp_path / "index"), str(tmp_path / "out")
    run = lambda job, **k: main([job, *(x for a, b in k.items() for x in ([f"--{a.replace('_', '-')}"] if b is True else [f"--{a.replace('_', '-')}", str(b)]))], spark)
    stats = run("generate", **names, place=place, output=f"{out}/candidates.tsv")
    want = candidates_of(rows)
    lines = (tmp_path / "out" / "candidates.tsv").read_text().splitlines()
    assert [x.split("\t")[0] for x in lines[1:]] == ["S1-4", "S1-3", "S1-2", "S1-1"] and stats["queries"] == 4 and stats["total_candidates"] == len(want)
    assert lines[4].split("\t")[1].split(",") == sorted((t for q, t in want if q == "S1-1"), key=lambda t: want["S1-1", t][1])
    # An interrupted build is taken up: what is there stays.
    (tmp_path / "index" / "signature.json").unlink()
    before = sorted(p.name for p in (tmp_path / "index" / "blocks").glob("part-*"))
    assert run("generate", **names, place=place, output=f"{out}/few.tsv", max_queries=2, resume=True)["queries"] == 2
    assert sorted(p.name for p in (tmp_path / "index" / "blocks").glob("part-*")) == before
    scored = run("write-scored-outputs", candidate_input=f"{out}/candidates.tsv", **names, place=place, output_dir=f"{out}/a", scores_output=f"{out}/scores.tsv", threshold=0.6)
    of = {r[0]: r for r in rows}
    good = {(q, t) for q, t in want if features_of(of[q], of[t])[1] >= 0.6}
    links = lambda path: {(a, x) for a, b in (y.split("\t") for y in (tmp_path / path).read_text().splitlines()[1:]) for x in b.split(",") if x}
    assert links("out/a/matching_results.tsv") == good and scored["matched_links"] == len(good) and scored["missing_target_links"] == 0
    assert (tmp_path / "out/a/candidate_pairs.tsv").read_text() == (tmp_path / "out/candidates.tsv").read_text()
    part = run("write-scored-outputs", candidate_input=f"{out}/candidates.tsv", **names, place=place, output_dir=f"{out}/b", candidate_limit=1, max_matches=1)
    assert links("out/b/candidate_pairs.tsv") == {(q, t) for (q, t), (_, rank) in want.items() if rank == 1} and part["input_candidate_links"] == len(want) > part["candidate_links"]
    made = run("write-outputs", source1=names["source1"], output_dir=f"{out}/c", candidate_input=f"{out}/candidates.tsv", scores_input=f"{out}/scores.tsv", threshold=0.6)
    assert links("out/c/matching_results.tsv") == good and made == {"rows": 4, "non_empty_candidates": 3, "non_empty_matches": len({q for q, _ in good})}
    assert run("write-outputs", source1=names["source1"], output_dir=f"{out}/d")["non_empty_matches"] == 0
    assert json.loads(run("score", truth=truth, predictions=f"{out}/a/matching_results.tsv", as_json=True))["entity_count"] == 4
    assert "best_threshold=" in run("thresholds", truth=truth, scores=f"{out}/scores.tsv", ids=ids, step=0.1)
    assert run("coverage", candidates=f"{out}/candidates.tsv", truth=truth, source1=names["source1"], ids=ids)["candidate_link_recall"]["all"] == 1.0
    with pytest.raises(ValueError, match="broken"):
        run("coverage", candidates=f"{out}/few.tsv", truth=truth, source1=names["source1"], ids=ids)
    told = run("describe", root=str(tmp_path), output=f"{out}/profile", seed="s", fraction=0.5, per_country=1)
    assert told["dev_ids"] == 3 and "| GB |" in (tmp_path / "out/profile/dataset_profile.md").read_text()
    more = put(tmp_path, "more.tsv", (tmp_path / "out/scores.tsv").read_text() + "\n".join("S1-5" + x[4:] for x in (tmp_path / "out/scores.tsv").read_text().splitlines() if x.startswith("S1-1")) + "\n")
    five, known = put(tmp_path, "five.tsv", (tmp_path / "train/train_ground_truth.tsv").read_text() + "S1-5\tS2-1\n"), put(tmp_path, "ids5.txt", "S1-1\nS1-2\nS1-3\nS1-4\nS1-5\n")
    model = run("train", scores=more, truth=five, ids=known, output=f"{out}/model.json")
    again = run("write-scored-outputs", candidate_input=f"{out}/candidates.tsv", **names, place=place, output_dir=f"{out}/e", model_json=f"{out}/model.json")
    assert again["scoring_mode"] == "logistic_model" and again["threshold"] == model["threshold"]


def test_index_and_stream(spark, tmp_path):
    targets = put(tmp_path, "t.tsv", HEAD + "S2-1\tAcme Robotics\t12 Main Town\tUS\nS3-2\tAcme Robotics\t\tUS\n")
    rows, place, sign = S.targets(spark, targets), str(tmp_path / "index"), I.signature(spark, [targets])
    blocks, _ = I.ensure(spark, rows, place, sign)
    assert I.finished(spark, place) and blocks.count() == B.exploded_keys(rows).count()
    I.ensure(spark, rows, place, sign)
    with pytest.raises(ValueError):
        I.ensure(spark, rows, place, "other")
    with pytest.raises(ValueError):
        I.build(rows.unionAll(rows), str(tmp_path / "twice"), sign)
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("S1-1", "Acme Robotics Inc", "12 Main, Town", "US")], "entity_id string, business_name string, business_address string, country string").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("entity_id string, business_name string, business_address string, country string").parquet(str(tmp_path / "in"))
    link_stream(stream, blocks, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {(r.query_id, r.target_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
