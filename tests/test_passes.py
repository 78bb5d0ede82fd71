import re

from pyspark.sql import functions as F

from threshline.operators import parse, passes

PREV, MSG = '<previousMessage from="Ann">Hi Ann-Marie.</previousMessage>', '<message from="Bob Lee">Bob Lee\'s chair. Ann nods at Bob.</message>'
FULL = 'pose="a" location="b" outfit="c" exposure="d" accessories="e" bodystate="f"'


def made(spark, before, after, *chain):
    text = f"{PREV}\n{before}\n{MSG}\n{after}"
    return passes.run_passes(parse.parse(spark.createDataFrame([(text, "a.txt")], "value string, file string")), chain)


def entries(df):
    return [(r.prompt.split("\n")[-1], r.target and r.target.attr, r.expected_value) for r in parse.to_entries(df).orderBy("_ord").collect()]


def test_unwinding_orders_and_depends(spark):
    got = entries(made(spark, "", '<stats character="Ann" mystery="m" exposure="x" location="l" pose="p" outfit="o" />', passes.unwind_stats))
    assert sorted(got, key=str) == sorted([
        ('<stats character="Ann" mystery="m" />', "mystery", "m"), ('<stats character="Ann" outfit="o" exposure="x" />', "exposure", "x"),
        ('<stats character="Ann" pose="p" location="l" />', "location", "l"), ('<stats character="Ann" pose="p" />', "pose", "p"), ('<stats character="Ann" outfit="o" />', "outfit", "o"),
    ], key=str)
    assert len(entries(made(spark, "", '<foo x="1" />', passes.unwind_stats))) == 1


def test_unchanged_values_are_marked(spark):
    got = entries(made(spark, '<stats character="Ann" pose="p" />', '<stats character="Ann" pose="p" outfit="o" />', passes.unwind_stats, passes.no_change))
    assert ('<stats character="Ann" pose="!!no_change!!" />', "pose", "p") in got and ('<stats character="Ann" outfit="o" />', "outfit", "o") in got


def test_duplicates(spark):
    for n, rows in (("3", 3), ("0", 0), ("-1", 0), ("x", 1)):
        assert made(spark, f'<augment duplicate="{n}" />', '<stats character="Ann" pose="p" />', passes.duplicate).count() == rows
    changed = passes.duplicate_changes("pose", 2.0)
    assert made(spark, '<stats character="Ann" pose="q" />', '<stats character="Ann" pose="p" />', passes.unwind_stats, changed).count() == 2
    assert made(spark, '<stats character="Ann" pose="p" />', '<stats character="Ann" pose="p" />', passes.unwind_stats, changed).count() == 1


def test_meta(spark):
    same = made(spark, f'<stats character="Ann" {FULL} />', f'<stats character="Ann" {FULL} />', passes.meta_updated)
    other = made(spark, f'<stats character="Ann" {FULL} />', f'<stats character="Ann" {FULL.replace('"f"', '"g"')} />', passes.meta_updated)
    part = made(spark, '<stats character="Ann" pose="a" />', f'<stats character="Ann" {FULL} />', passes.meta_updated)
    assert [sorted(x[0] for x in entries(d) if "meta" in x[0]) for d in (same, other, part)] == [['<meta character="Ann" updated="false" />'], ['<meta character="Ann" updated="true" />'], []]
    assert [len(entries(d)) for d in (same, other, part)] == [2, 2, 1]


def test_mirror_keeps_other_places(spark):
    got = made(spark, '<stats character="A" p="1" /><foo x="1" /><stats character="B" p="2" /><stats scene="h" f="3" />', '<stats character="A" p="1" />', passes.mirror())
    shown = sorted(re.findall(r'="([ABh1])"', r.prompt.split("\n")[1] + r.prompt.split("\n")[2] + r.prompt.split("\n")[3] + r.prompt.split("\n")[4]) for r in parse.to_entries(got).collect())
    assert len(shown) == 2 and shown[0] != shown[1]


def test_renaming_is_consistent_and_stable(spark):
    df = made(spark, '<stats character="Ann" p="near Bob Lee" />', '<stats character="Bob Lee" p="1" />', passes.unwind_stats, passes.rename(0.0, ["Zoe", "Max", "Kim"]))
    first = parse.to_entries(df).first()
    assert first == parse.to_entries(df.repartition(3)).first()
    assert "Bob" not in first.prompt and "Lee" not in first.prompt and not re.search(r"\bAnn\b", first.prompt)
    new = first.target.subject_id
    assert f'<message from="{new}">{new}\'s chair.' in first.prompt and f'p="near {new}"' in first.prompt
    assert first.id.split(":")[-2] == "Bob Lee"
    full = parse.to_entries(made(spark, "", '<stats character="Ann" p="1" /><foo who="Ann" />', passes.rename(1.0))).collect()
    assert all('<foo who="Ann" />' in r.prompt or "foo" not in r.prompt for r in full)
    assert len(passes.name_pool()) == len(set(passes.name_pool())) >= 500


def test_chains_on_the_same_input(spark):
    before, after = '<augment duplicate="2" /><stats character="Ann" pose="p" />', '<stats character="Ann" pose="p" outfit="o" />'
    assert made(spark, before, after, *passes.CHAT_TRAIN).count() == 4
    assert made(spark, before, after, *passes.CHAT_EVAL).count() == 2
    assert made(spark, before, after, *passes.SYNTHETIC).count() == 4
    assert made(spark, before, after).select(passes.content_key().alias("k")).distinct().count() == 1
    assert made(spark, before, after).filter(F.col("target").isNotNull()).count() == 0


def test_fractions_of_copies_follow_the_content(spark):
    texts = [(f'{PREV}\n<stats character="Ann" pose="p{i}" />\n{MSG}\n<stats character="Ann" pose="q{i}" />', f"f{i}.txt") for i in range(200)]
    points = parse.parse(spark.createDataFrame(texts, "value string, file string"))

    def counts(rows):
        out = passes.run_passes(rows, [passes.unwind_stats, passes.duplicate_changes("pose", 2.25, seed=3)])
        return {r.source_id: r["count"] for r in out.groupBy("source_id").count().collect()}

    got = counts(points)
    assert len(got) == 200 and set(got.values()) == {2, 3} and 20 <= sum(n == 3 for n in got.values()) <= 85
    assert got == counts(points.repartition(7))
