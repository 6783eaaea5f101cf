import json

import pytest
from pyspark.sql import functions as F

from parley import schemas as Z
from parley.plans.dataset import DatasetConfig, run_pipeline
from parley.sources import readers as R
from parley.sources import writers as W


def test_delimited(spark, tmp_path):
    path = tmp_path / "lines.txt"
    rows = ["L1 +++$+++ u0 +++$+++ m0 +++$+++ JOSÉ +++$+++ He said \"no\", café.",
            "L2 +++$+++ u1 +++$+++ m0 +++$+++ ANN +++$+++ ", "L3 +++$+++ u1 +++$+++ m0 +++$+++ ANN +++$+++ NA"]
    path.write_bytes("\n".join(rows).encode("iso-8859-1"))
    got = {r.line_id: r for r in R.read_table(spark, R.TableSpec(str(path), Z.LINES)).collect()}
    assert (got["L1"].character_name, got["L1"].utterance) == ("JOSÉ", 'He said "no", café.')
    assert (got["L2"].character_name, got["L2"].utterance) == ("ANN", None)
    assert got["L3"].utterance == "NA"


def test_split_delimited(spark):
    rows = spark.createDataFrame([("a +++$+++ b +++$+++ c +++$+++ d",), ("a",), ("a +++$+++  +++$+++ c",)], "v string")
    got = [tuple(r) for r in R.split_delimited(rows, "v", ["x", "y", "z"]).collect()]
    assert got == [("a", "b", "c +++$+++ d"), ("a", None, None), ("a", None, "c")]


def test_csv_round_trip_and_projection(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    rows = [("a \"q\", b", 1, None), ("line\nbreak é", None, "x")]
    df = spark.createDataFrame(rows, "s string, n int, o string")
    W.write_table(df, path, "csv")
    back = R.read_table(spark, R.TableSpec(path, df.schema))
    assert {tuple(r) for r in back.collect()} == set(rows)
    some = R.read_table(spark, R.TableSpec(path, df.schema, columns=("n",)))
    assert some.columns == ["n"]


def test_csv_of_nested_columns(spark, tmp_path):
    path = str(tmp_path / "n.csv")
    df = spark.createDataFrame([([1, 2], ("x", None))], "a array<int>, s struct<k: string, v: int>")
    W.write_table(df, path, "csv")
    row = spark.read.option("header", True).option("escape", '"').csv(path).first()
    assert (row.a, json.loads(row.s)) == ("[1,2]", {"k": "x", "v": None})


def test_json_array_and_lines(spark, tmp_path):
    path = tmp_path / "qa.json"
    path.write_text(json.dumps([{"question": "é?", "imdb_key": "k", "answers": ["a"], "correct_index": None}],
                               ensure_ascii=False, indent=1), encoding="utf-8")
    rows = R.read_table(spark, R.TableSpec(str(path), Z.QA))
    assert rows.first().question == "é?" and rows.first().correct_index is None
    out = str(tmp_path / "lines")
    R.json_array_to_lines(spark, str(path), Z.QA, out)
    assert R.read_table(spark, R.TableSpec(out, Z.QA, "json")).collect() == rows.collect()
    assert '"correct_index":null' in "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*"))


def test_table_choice(spark):
    assert R.format_of(R.TableSpec("a/b.txt", Z.LINES)) == "delimited"
    with pytest.raises(ValueError):
        R.format_of(R.TableSpec("a/b.xyz", Z.LINES))
    with pytest.raises(ValueError):
        R.format_of(R.TableSpec("a/b.txt", Z.LINES, "orc2"))
    with pytest.raises(ValueError):
        R.read_tables(spark, {}, ["qa"])


def test_manifest_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    row, other = W.manifest({"t": df, "u": df.orderBy(F.desc("i"))}).collect()
    assert (row.table_name, row.n_rows, row.column_names) == ("t", 2, "i, s")
    assert row.content_hash == other.content_hash
    path = str(tmp_path / "metrics")
    for run in ("a", "b"):
        W.log_metrics(W.metrics_rows(spark.createDataFrame([(0.5, 1.0)], "bleu double, f1 double"), run), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {
        (r, m, v) for r in "ab" for m, v in (("bleu", 0.5), ("f1", 1.0))}


def raw_tables(frame):
    lines = [(f"L{c}_{t}", "u0", f"m{c % 3}", "ann" if t % 2 else "bob", f"say {c} {t}")
             for c in range(60) for t in range(1 + c % 4)]
    conversations = [("u0", "u1", f"m{c % 3}", str([f"L{c}_{t}" for t in range(1 + c % 4)])) for c in range(60)]
    return {
        "movie_conversations": frame(conversations, Z.CONVERSATIONS),
        "movie_lines": frame(lines, Z.LINES),
        "movie_titles_metadata": frame([(f"m{i}", f"film {i}", f"200{i}/I", 6.0 + i, 10 * i, "['drama']") for i in range(3)], Z.TITLES),
        "movie_characters_metadata": frame([("u0", "ann", "m0", "film 0", "f", "1"), ("u1", "bob", "m0", "film 0", "m", "2")], Z.CHARACTERS),
        "movie_details": frame([("film 0", "p0"), ("film 0", "p0")], "movie_name string, plot_outline string"),
        "qa": frame([(f"q{i % 30}", f"k{i % 2}", ["a", "b"], None if i % 10 == 9 else i % 2) for i in range(60)], Z.QA),
        "movies": frame([("k0", "film 0", 2000, "drama"), ("k1", "film 1", 2001, "war")], Z.QA_MOVIES),
        "qa_details": frame([("film 1", "p1")], Z.QA_DETAILS),
    }


def test_pipeline(spark, frame, tmp_path):
    config = DatasetConfig(dialogue_min_rows=10, qa_min_rows=10, sample_fraction=1.0)
    outs = [run_pipeline(raw_tables(frame), str(tmp_path / name), config) for name in "ab"]
    rows, again = ({json.dumps(r.asDict(True), sort_keys=True) for r in o.collect()} for o in outs)
    assert rows == again
    counts = {(r.type, r.split): r["count"] for r in outs[0].groupBy("type", "split").count().collect()}
    dialogue = 60 + 3 * 4
    train, test = int(dialogue * 0.7), int(dialogue * 0.297)
    assert counts[("dialogue", "train")] == train and counts[("dialogue", "test")] == test
    assert counts[("dialogue", "val")] == dialogue - train - test
    answered = sum(v for (kind, _), v in counts.items() if kind == "qa")
    assert answered == 54 and counts[("qa", "train")] == int(54 * 0.8)
    assert "split=train" in {p.name for p in (tmp_path / "a").iterdir()}
    with pytest.raises(ValueError):
        run_pipeline({}, str(tmp_path / "c"))


TEXTS = ['plain', 'a "quoted" word', 'two\nlines', '"', '""', '\n\n', 'x\n"y"\nz, w', '', None, '{"a": "}"}', 'é\\', '\\"}', 'long ' * 50]


@pytest.fixture()
def small_splits(spark):
    """Files are cut into byte ranges of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quoted_csv_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rows = [(i, TEXTS[i % len(TEXTS)], i / 2 if i % 3 else None) for i in range(300)]
    schema = "n int, s string, x double"
    path = str(tmp_path / "t.csv")
    W.write_table(spark.createDataFrame(rows, schema).coalesce(1), path, "csv")
    spec = R.TableSpec(path, spark.createDataFrame([], schema).schema)
    split = R.read_table(spark, spec)
    whole = R.read_table(spark, R.TableSpec(path, spec.schema, options={"mode": "PERMISSIVE"}))
    key = lambda r: r.n
    assert sorted(split.collect(), key=key) == sorted(whole.collect(), key=key)
    assert split.count() == 300 and split.rdd.getNumPartitions() > 20


def test_windows_line_ends(spark, tmp_path, small_splits):
    lines = ["n,s"] + [f'{i},"a{i}"' if i % 2 else f'{i},"x\r\ny"' for i in range(80)] + [""]
    (tmp_path / "w.csv").write_bytes("\r\n".join(lines).encode())
    rows = {r.n: r.s for r in R.read_table(spark, R.TableSpec(str(tmp_path / "w.csv"), Z._struct(("n", Z._I), ("s", Z._S)))).collect()}
    assert len(rows) == 80 and rows[1] == "a1" and rows[2].replace("\r", "") == "x\ny"


@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_is_read_by_many_tasks(spark, tmp_path, small_splits, indent):
    items = [{"n": i, "s": TEXTS[i % len(TEXTS)], "o": {"k": "}{" if i % 2 else "\\", "l": [{"m": i}]}} for i in range(200)]
    for name, some in (("a", items[:120]), ("b", items[120:]), ("c", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps(some, ensure_ascii=False, indent=indent), encoding="utf-8")
    schema = spark.createDataFrame([], "n int, s string, o struct<k: string, l: array<struct<m: int>>>").schema
    spec = R.TableSpec(str(tmp_path), schema, "json_array")
    split = R.read_table(spark, spec)
    got = {r.n: r.asDict(True) for r in split.collect()}
    assert [got[i] for i in range(200)] == items and len(got) == 200
    assert split.rdd.getNumPartitions() > 20


def test_manifest_comes_with_the_write(spark, tmp_path):
    frames = {"a": spark.createDataFrame([(1, "x", [0.5]), (2, None, None)], "i int, s string, v array<double>"),
              "b": spark.createDataFrame([], "i int, s string")}
    got = W.write_with_manifest(frames, str(tmp_path), rules={"no_text": F.col("s").isNull()})
    rows = {r.table_name: r for r in got.collect()}
    assert (rows["a"].n_rows, rows["a"].no_text, rows["b"].n_rows, rows["b"].content_hash) == (2, 1, 0, 0)
    back = W.manifest({n: spark.read.parquet(str(tmp_path / n)) for n in frames})
    assert {tuple(r)[:4] for r in got.collect()} == {tuple(r) for r in back.collect()}


def test_json_array_files(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(7)], "i int, s string").repartition(3)
    W.write_json_array(df, str(tmp_path / "j"))
    found = [x for p in (tmp_path / "j").glob("part-*") for x in json.loads(p.read_text())]
    assert sorted(found, key=lambda x: x["i"]) == [{"i": i, "s": None if i % 2 else "x"} for i in range(7)]
