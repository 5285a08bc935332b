"""Readers and writers on small files made by hand."""

import pytest

from wordgrove.operators.validate import check_file
from wordgrove.sources import files as fl

V1 = "0\tdog\tdog-1\tN\t\n1\tdoggie\tdoggie\tN\t0\n2\tdoghouse\tdoghouse\tNC\t\n"
V2 = (
    "0.0\twork#N\twork\tN\t\t\t\t\t\t{}\n"
    '0.1\tworker#N\tworker\tN\tAnimacy=Anim\tMorph=work&Type=Root|Morph=er&Type=Suffix\t0.0\tType=Derivation\t\t{"techlemma": "worker"}\n'
    "0.2\thomework#N\thomework\tN\t\t\t0.0\tSources=1.0,0.0&Type=Compounding\t\t{}\n"
    "\n"
    "1.0\thome#N\thome\tN\t\t\t\t\t\t{}\n"
)


def written(tmp_path, text, name="f.tsv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_forest_v1_round_trip(spark, tmp_path):
    bundle = fl.read_forest_v1(spark, written(tmp_path, V1))
    rows = {r.lemma: r for r in bundle.lexemes.collect()}
    assert rows["doghouse"].is_compound and rows["doghouse"].pos == "N" and rows["dog"].techlemma == "dog-1"
    assert [(r.main_source, r.target) for r in bundle.relations.collect()] == [(0, 1)]
    fl.write_forest_v1(bundle.lexemes, bundle.relations, str(tmp_path / "out"))
    again = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert again == V1


@pytest.fixture
def uncoalesced(spark):
    """Small shuffles keep their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_forest_v1_in_several_files(spark, tmp_path, uncoalesced):
    text = "".join(f"{i}\tw{i}\tw{i}\tN\t{i // 2 if i else ''}\n" for i in range(300))
    bundle = fl.read_forest_v1(spark, written(tmp_path, text))
    fl.write_forest_v1(bundle.lexemes, bundle.relations, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 1 and "".join(p.read_text() for p in parts) == text
    # lines of a folder are numbered over its files, so the later one of two rows of an id is the repeated one
    (tmp_path / "out" / "part-99999.txt").write_text("7\tagain\tagain\tN\t\n")
    again = fl.read_forest_v1(spark, str(tmp_path / "out"), on_err="continue")
    assert {r.lex_id: (r.seq, r.lemma) for r in again.lexemes.collect()} == {i: (i + 1, f"w{i}") for i in range(300)}
    assert [(r.line_no, r.problem) for r in again.errors.collect()] == [(1, "repeated id")]


@pytest.mark.parametrize(
    ("line", "problem"),
    [("0\ta\ta\tN", "not five fields"), ("-1\ta\ta\tN\t", "bad id"), ("0\t\ta\tN\t", "empty lemma"), ("0\ta\ta\tN\t9", "unknown parent"), ("0\ta\ta\tN\t0", "own parent"), ("0\ta\ta\tN\tx", "bad parent id")],
)
def test_forest_v1_bad_lines(spark, tmp_path, line, problem):
    path = written(tmp_path, line + "\n")
    with pytest.raises(ValueError, match=problem):
        fl.read_forest_v1(spark, path)
    kept = fl.read_forest_v1(spark, path, on_err="continue")
    assert [r.problem for r in kept.errors.collect()] == [problem] and kept.lexemes.count() == 0


def test_repeated_id(spark, tmp_path):
    bundle = fl.read_forest_v1(spark, written(tmp_path, V1 + "1\tcat\tcat\tN\t\n"), on_err="continue")
    assert [(r.line_no, r.problem) for r in bundle.errors.collect()] == [(4, "repeated id")]


def test_network_v2(spark, tmp_path):
    bundle = fl.read_network_v2(spark, written(tmp_path, V2))
    lexemes = {r.lemma: r for r in bundle.lexemes.collect()}
    assert lexemes["worker"].feats == {"Animacy": "Anim"}
    assert [(m.morph, m.type) for m in lexemes["worker"].morphs] == [("work", "Root"), ("er", "Suffix")]
    relations = {r.target: r for r in bundle.relations.collect()}
    assert relations["0.2"].sources == ["1.0", "0.0"] and relations["0.2"].type == "Compounding"


def test_network_v2_json_morphs(spark, tmp_path):
    text = V2.replace("Morph=work&Type=Root|Morph=er&Type=Suffix", '[{"Morph": "work", "type": "Root"}, {"morph": "er", "Type": "Suffix"}]')
    rows = fl.read_network_v2(spark, written(tmp_path, text)).lexemes.where("lemma = 'worker'").collect()
    assert [(m.morph, m.type) for m in rows[0].morphs] == [("work", "Root"), ("er", "Suffix")]


def test_network_v2_round_trip(spark, tmp_path):
    first = fl.read_network_v2(spark, written(tmp_path, V2))
    fl.write_network_v2(first.lexemes, first.relations, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    second = fl.read_network_v2(spark, written(tmp_path, text, "g.tsv"))
    assert text.count("\n\n") == 1
    key = lambda b: sorted((r.lemma, str(r.feats), str(r.morphs)) for r in b.lexemes.collect())
    assert key(first) == key(second)
    names = lambda b: {r.lex_id: r.lemma for r in b.lexemes.collect()}
    edges = lambda b: sorted((r.type, names(b)[r.target], [names(b)[s] for s in r.sources]) for r in b.relations.collect())
    assert edges(first) == edges(second)


def test_network_v2_in_several_files(spark, tmp_path, uncoalesced):
    """A tree that lies in several files, its parents in other ones."""
    lexemes = spark.range(300).selectExpr("cast(id AS string) AS lex_id", "concat('w', id, '#N') AS lemid", "concat('w', id) AS lemma", "'N' AS pos", "map() :: map<string,string> AS feats", "cast(array() AS array<struct<start:int,end:int,morph:string,type:string>>) AS morphs", "'{}' AS misc")
    relations = spark.range(2, 300).selectExpr("'Derivation' AS type", "cast(id - 2 AS string) AS main_source", "array(cast(id - 2 AS string)) AS sources", "cast(id AS string) AS target", "0 AS ord", "map() :: map<string,string> AS feats")
    fl.write_network_v2(lexemes, relations, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert len(parts) > 1 and text.count("\n\n") == 1
    order = [f"{i % 2}.{i // 2}" for i in [*range(0, 300, 2), *range(1, 300, 2)]]
    assert [line.split("\t")[0] for line in text.splitlines() if line] == order
    again = fl.read_network_v2(spark, str(tmp_path / "out"))
    assert [r.lex_id for r in again.lexemes.orderBy("seq").collect()] == order and again.relations.count() == 298


@pytest.mark.parametrize(
    ("old", "new", "problem"),
    [("0.1\t", "00.1\t", "bad id"), ("\twork\tN", "\t\tN", "empty lemma"), ("{}\n\n", "{\n\n", "bad JSON"), ("\t0.0\tType=Derivation", "\t0.9\tType=Derivation", "unknown parent"), ("Type=Derivation", "Type=Other", "unknown type"), ("Type=Derivation", "x=y", "missing type"), ("\t0.0\tType=Derivation", "\t1.0\tType=Derivation", "parent in another tree")],
)
def test_network_v2_bad_lines(spark, tmp_path, old, new, problem):
    with pytest.raises(ValueError, match=problem):
        fl.read_network_v2(spark, written(tmp_path, V2.replace(old, new, 1)))


def test_check_file(spark, tmp_path):
    lines = fl.read_lines(spark, written(tmp_path, V2.replace("\n\n", "\n")))
    assert {r.problem for r in check_file(lines).collect()} == {"several trees in a block"}
    assert check_file(fl.read_lines(spark, written(tmp_path, V2))).count() == 0


def test_pairs_and_annotations(spark, tmp_path):
    bundle = fl.read_pairs_unimorph(spark, written(tmp_path, "work\tworker\tV:N\ter\nwork\twork\tV:V\t\n"), on_err="continue")
    assert [(r.main_source, r.target, r.affix) for r in bundle.relations.collect()] == [("work#V", "worker#N", "er")]
    assert [r.problem for r in bundle.errors.collect()] == ["derives itself"]
    rows = fl.read_annotations(spark, written(tmp_path, "# c\n\n§a-N\tb-N\n\\c\td\n", "a.tsv"), ["a", "b"], marks="§\\\\").orderBy("line_no").collect()
    assert [(r.line_no, r.mark, r.a, r.b) for r in rows] == [(3, "§", "a-N", "b-N"), (4, "\\", "c", "d")]


def test_records_and_tables(spark, tmp_path):
    rows = fl.read_records(spark, written(tmp_path, "word: pes\nforms: psa, psu\nword: kos\nforms: kosa\n"), list_fields=("forms",)).orderBy("record").collect()
    assert [(r.word, r.forms) for r in rows] == [("pes", ["psa", "psu"]), ("kos", ["kosa"])]
    table = fl.read_segmentation_table(spark, written(tmp_path, "undone\tun\tdo\tne\nwrong\tw\tx\t\n", "s.tsv"), 0, [1, 2, 3]).collect()
    assert [(r.word, r.segments) for r in table] == [("undone", "un-do-ne")]


def test_candidate_blocks_and_snapshot(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "g string, v string")
    fl.write_candidate_blocks(df, "g", F.col("v"), str(tmp_path / "blocks"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "blocks").glob("part-*"))) == "x\ny\n\nz\n\n"
    bundle = fl.read_forest_v1(spark, written(tmp_path, V1))
    fl.write_snapshot(bundle, str(tmp_path / "snap"))
    assert fl.read_snapshot(spark, str(tmp_path / "snap"))[0].count() == 3
