"""Documents read by many tasks give what one parser reads of the whole text."""

import json
import random

import pytest


from trajloom.sources import readers

ODD = ["a", "b,c", 'q"uo"te', "back\\slash\\", "br{ace}[et]", "näme 漢", "tab\there", "\\\",", "x" * 300, "{", "],", "1"]


@pytest.fixture
def ranges(spark):
    """Files are dealt in ranges of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def names(rng, n):
    return [rng.choice(ODD) + str(rng.randint(0, 99)) for _ in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_index_documents(spark, tmp_path, ranges, indent):
    rng, want = random.Random(4), {}
    for k in range(6):
        entries = []
        for _ in range(rng.randint(1, 5)):
            e = {"output_dir": rng.choice(ODD), "more": {"sample": ["no, id"], "deep": [1, [2, {"x": "y,z"}]]}}
            if rng.random() < 0.7:
                e["sample_ids"] = [*names(rng, rng.randint(0, 60)), ""]
            if rng.random() < 0.5:
                e["sample_id"] = rng.choice(ODD)
            keys = list(e)
            rng.shuffle(keys)
            entries.append({key: e[key] for key in keys})
        doc = entries if k else entries[0]
        (tmp_path / f"{k}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(k % 2)))
        listed = entries if k else entries[:1]
        want[f"{k}.json"] = [i for e in listed for i in [*([e["sample_id"]] if "sample_id" in e else []), *e.get("sample_ids", [])] if i]
    got = readers.read_index(spark, str(tmp_path), document=True).orderBy("pos").collect()
    by = {n: [r.sample_id for r in got if r.pos.file.endswith(n)] for n in want}
    assert by == want
    assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 5


def test_indented_and_line_files_side_by_side(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"sample_ids": ["i", "j"], "output_dir": "o"}], indent=2))
    (tmp_path / "b.json").write_text('{"sample_ids": ["k"]}\n{"sample_id": "l"}\n')
    assert sorted(r.sample_id for r in readers.read_index(spark, str(tmp_path)).collect()) == ["i", "j", "k", "l"]


def test_broken_documents_are_errors(spark, tmp_path):
    for k, text in enumerate(['[{"sample_ids": ["a", "b"]', '[{"sample_id": "a]', '"a"', '[{"sample_id": "a"}]]', '{"sample_id": "a"}\n{"sample_id": "b"}\nrest', '[{"sample_id": "a"} "b"]']):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "x.json").write_text(text)
        with pytest.raises(Exception, match="JSON document"):
            readers.read_index(spark, str(tmp_path / str(k)), document=True).collect()


@pytest.mark.parametrize("indent", [None, 1])
def test_task_documents(spark, tmp_path, ranges, indent):
    rng = random.Random(7)
    tasks = {
        f"{name}{k}": {"status": rng.choice(["done", "failed"]), "payload": json.dumps({"p": name}), "artifacts": [name, "b}"], "attempts": k}
        if rng.random() < 0.9 else rng.choice(["text, no object", 5, None, [1, {"a": 2}]])
        for k, name in enumerate(ODD * 8)
    }
    docs = {"a": {"version": 1, "tasks": tasks, "other": {"x": {"status": "no"}}}, "b": {"tasks": {}}, "c": {"tasks": {"only": {"status": "done"}}}, "d": {"none": 1}}
    for n, doc in docs.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(doc, indent=indent))
    got = {r.sample_id: r for r in readers.read_task_json(spark, str(tmp_path)).collect()}
    want = {i: e for d in docs.values() for i, e in d.get("tasks", {}).items() if isinstance(e, dict)}
    assert set(got) == set(want)
    for i, e in want.items():
        assert (got[i].status, got[i].payload, got[i].artifacts, got[i].attempts) == (e["status"], e.get("payload", "{}"), e.get("artifacts", []), e.get("attempts", 0))
    text = spark.createDataFrame([(json.dumps(docs["a"]),)], "value string")
    whole = {r.sample_id: r for r in readers.parse_task_json(text, "value").collect()}
    assert {i: r.asDict() for i, r in got.items() if i != "only"} == {i: r.asDict() for i, r in whole.items()}
