import pytest
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions import entities as N
from threshline.operators import parse

PREV, MSG = '<previousMessage from="Ann">Hi.</previousMessage>', '<message from="Bob">Hello <b>you</b>.</message>'
ANN, BOB, HALL = '<stats character="Ann" pose="sits" />', '<stats character="Bob Lee" pose="stands" />', '<stats scene="hall" fixtures="lamp" items="book" />'


def points(text, warnings=None):
    return list(parse.parse_text(text, "f.txt", (warnings if warnings is not None else []).append))


def test_one_and_several():
    assert len(points(f"{PREV}{MSG}{ANN}")) == 1
    ann, hall = points(f"{PREV}\n{BOB}\n{MSG}\n{ANN}\n{HALL}")
    assert ann["state_context"] == [] and [e["cls"] for e in hall["state_context"]] == ["CharacterStats"]
    assert [e["subject"]["id"] for e in ann["previous_state"]] == ["Bob Lee"]
    assert ann["source_id"] == "f.txt:1" and ann["message"]["text"] == "Hello <b>you</b>."


@pytest.mark.parametrize(
    "text, n, said",
    [
        (f"{PREV}{MSG}", 0, "no state"),
        (f"{MSG}{ANN}{PREV}{MSG}{ANN}", 0, None),
        (f"{PREV}{PREV}{MSG}{ANN}", 1, "no message"),
        (f"{PREV}{MSG}{ANN}{MSG}{BOB}{PREV}{MSG}{ANN}", 2, "repeated"),
        ("<previousMessage>open <message>x</message>" + ANN, 0, "not closed"),
        (f"{PREV}<message>open{ANN}", 0, "not closed"),
        (f"{PREV}<message>open{PREV}{MSG}{ANN}", 1, None),
        (f'{PREV}{MSG}<stats character="Ann" location="a/b" />', 0, "no state"),
        ("", 0, None),
    ],
)
def test_what_is_skipped(text, n, said):
    warnings = []
    assert len(points(text, warnings)) == n
    assert not warnings if said is None else any(said in w for w in warnings)


def test_entities():
    e = parse.make_entity("stats", 'character="Ann" pose="a" pose="b"')
    assert (e["cls"], e["attrs"], e["attr_order"]) == ("CharacterStats", {"pose": "b"}, ["pose", "pose"])
    assert parse.make_entity("stats", 'pose="x"')["cls"] == "GenericEntity"
    assert parse.make_entity("stats", 'character="" pose="x"')["cls"] == "GenericEntity"
    assert parse.make_entity("foo", 'x="1"')["tag"] == "foo"
    assert parse.make_entity("stats", r'character="Ann" pose="say \"x\""')["attrs"]["pose"] == r"say \"x\""
    assert parse.make_entity("stats", 'character="Zoé" élan="né"')["attrs"] == {"élan": "né"}
    assert len(parse.entities_in(ANN + ANN.replace("sits", "runs") + '<foo x="1" /><foo x="1" />')) == 3


def test_names_of_tags(spark):
    found = parse.entities_in('<my-tag a="1" /><9x b="2" /><-x c="3" /><é d="4" /><_x e="5" /><A9_b-c f="6" />')
    assert [(e["tag"], e["attrs"]) for e in found] == [("my-tag", {"a": "1"}), ("A9_b-c", {"f": "6"})]
    row = spark.createDataFrame([('<my-tag a="1" /><9x b="2" /><stats-2 character="Ann" />',)], "s string").select(N.entities_in(F.col("s")).alias("e")).first()
    assert [(e.tag, e.cls) for e in row.e] == [("my-tag", "GenericEntity"), ("stats-2", "GenericEntity")]


def test_line_numbers():
    assert points("\n" * 6 + f"{PREV}\n{MSG}\n{ANN}")[0]["source_id"] == "f.txt:7"


def test_round_trip_and_columns_agree(spark):
    text = f'{PREV}\n<augment duplicate="2" />\n{BOB}\n{MSG}\n{ANN}\n{HALL}\n<foo x="1" />'
    once = parse.to_entries(parse.parse(spark.createDataFrame([(text, "a.txt"), (None, "b.txt")], "value string, file string")))
    prompts = [r.prompt for r in once.orderBy("_ord").collect()]
    assert prompts[0] == f'{PREV}\n<augment duplicate="2" />\n{BOB}\n{MSG}\n{ANN}' and prompts[1] == f'{PREV}\n<augment duplicate="2" />\n{BOB}\n{MSG}\n{ANN}\n{HALL}'
    again = parse.to_entries(parse.parse(once.select(F.col("prompt").alias("value"), F.col("id").alias("file"))))
    assert prompts[0] in [r.prompt for r in again.collect()]
    spans = [ANN + BOB + HALL + ANN, '<character name="X" a="1" /><augment duplicate="3" /><stats pose="q" /><foo x="1" y="2" x="3" />', "none", r'<stats character="A" p="say \"x\"" />']
    rows = spark.createDataFrame([(s,) for s in spans], "s string").select("s", N.keep_first(N.entities_in(F.col("s"))).alias("e"))
    for r in rows.collect():
        assert [x.asDict(True) for x in r.e] == parse.entities_in(r.s)


def test_array_functions(spark):
    e = F.col("e")
    target = F.struct(F.lit("Stats").alias("entity"), F.lit(None).cast("string").alias("subject_id"), F.lit("pose").alias("attr"))
    row = spark.createDataFrame([(parse.entities_in(ANN + BOB + HALL),)], f"e array<{S.ENTITY.simpleString()}>")
    got = row.select(
        F.size(N.of_type(e, "CharacterStats")).alias("people"), N.target_value(e, target).alias("pose"), N.target_value(e, target.withField("attr", F.lit("no")), F.lit("none")).alias("none"),
        N.texts_of(N.set_target_value(e, target, F.lit("new"))).alias("changed"), N.find_matching(e, F.get(e, F.lit(1)))["subject"]["id"].alias("bob"),
        N.merge_attrs([F.get(e, F.lit(0))["attrs"], F.get(e, F.lit(1))["attrs"]]).alias("merged"), F.size(N.where(e, lambda x: x["tag"] == "none")).alias("nothing"),
        N.line_number(F.lit("a\nb\nc"), F.lit(5)).alias("line"), N.target_entity(e, target.withField("subject_id", F.lit("hall")))["cls"].alias("scene"),
    ).first()
    assert (got.people, got.pose, got.none, got.bob, got.merged, got.nothing, got.line, got.scene) == (2, "sits", "none", "Bob Lee", {"pose": "stands"}, 0, 3, "SceneStats")
    assert got.changed == [ANN.replace("sits", "new"), BOB, HALL]
    with pytest.raises(Exception, match="several"):
        row.select(N.target_entity(e, target.withField("entity", F.lit("CharacterStats")))).collect()
