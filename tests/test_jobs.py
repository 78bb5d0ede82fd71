import json

import pytest
from pyspark.sql import functions as F

from threshline.operators import reports
from threshline.plans import jobs
from threshline.plans.derive import annotated, entries
from threshline.sources import readers
from threshline.streaming import incremental

DIR = "/root/testdata/sf0.001"


def test_prepare_with_a_cache_gives_the_same(spark, tmp_path):
    files = annotated(spark, DIR)
    options = jobs.Prepare("eval", cache_path=f"file://{tmp_path}/cache")
    plain = sorted(r.id + r.prompt for r in jobs.prepare(files, jobs.Prepare("eval")).collect())
    first = sorted(r.id + r.prompt for r in jobs.prepare(files.limit(5), options).collect())
    both = [sorted(r.id + r.prompt for r in jobs.prepare(files, options).collect()) for _ in range(2)]
    assert len(first) < len(plain) and set(first) <= set(plain)
    assert both == [plain, plain]
    assert jobs.prepare(files, jobs.Prepare("eval", ["pose"], with_loss=False)).select("target.attr").distinct().collect() == [("pose",)]


def test_assemble(spark):
    rows = entries(spark, DIR).distinct()
    key = F.substring("_ord", 1, 12).cast("long")
    train, held, synthetic = rows.filter(key % 3 != 0), rows.filter((key % 3 == 0) & (key % 2 == 0)), rows.filter((key % 3 == 0) & (key % 2 == 1))
    o = jobs.Assembly(batch=24, batches=60, regular=5, eval_size=100, big_eval_size=900, low_per_epoch=50, epochs=1, clean_synthetic=True)
    parts = {k: v.cache() for k, v in jobs.assemble(train, synthetic, held, o).items()}
    ids = {r.id for r in parts["eval"].collect() if r.id}
    assert parts["eval"].count() == 100 and parts["big_eval"].count() == 900 and parts["train_low"].count() == 120
    assert not ids & {r.id for p in ("train_high", "train_low") for r in parts[p].select("id").collect()}
    assert not {r._ord for r in parts["train_high"].select("_ord").collect()} & {r._ord for r in parts["train_low"].select("_ord").collect()}
    sizes = {r.batch_id: r["count"] for r in parts["train_high"].groupBy("batch_id").count().collect()}
    assert sorted(set(sizes.values()))[-1] == 24 and sum(n < 24 for n in sizes.values()) <= 1
    assert all(df.count() >= 0 for df in jobs.assembly_reports(parts, rows).values())
    assert jobs.inspect(rows, flips_only=True, threshold=8.0, query=":1").filter("loss_metrics.worst_loss <= 8").count() == 0


def test_stage0(spark):
    rows = entries(spark, DIR).distinct().filter(F.substring("_ord", 1, 12).cast("long") % 40 == 0)
    parts = jobs.assemble_stage0(rows, rows, 10, 2)
    out = parts["train"]
    assert out.count() % 20 == 0 and out.groupBy("epoch", "batch_id").count().filter("count <> 10").count() == 0
    assert reports.epoch_uniqueness(out.select("epoch", "batch_id", "id")).first().same_batch_pct < 60


def test_command_line_and_stream(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    text = '<previousMessage from="Ann">Hi.</previousMessage>\n<message from="Bob">Yes.</message>\n<stats character="Ann" pose="sits" outfit="o" />\n'
    for name in ("a.txt", "sub/b.train.txt", "c.eval.TXT"):
        (tmp_path / "in" / name).write_text(text + '<stats character="X" p="1" q="2" />\n')
    jobs.main(["prepare", "--chain", "eval", f"{tmp_path}/in", f"{tmp_path}/entries", "--clean"])
    assert readers.jsonl(spark, f"{tmp_path}/entries").count() == 12
    jobs.main(["chats", f"{tmp_path}/in", f"{tmp_path}/chats"])
    line = json.loads(next(x for f in (tmp_path / "chats").glob("part*") for x in f.read_text().splitlines()))
    assert (line["name"], line["mes"], line["present"]) == ("Bob", "Yes.", ["Ann.png", "X.png"])
    jobs.main(["embeddings", f"{tmp_path}/in", f"{tmp_path}/emb"])
    assert spark.read.json(f"{tmp_path}/emb/train").count() == 2
    jobs.main(["stage0", f"{tmp_path}/entries", f"{tmp_path}/stage0", "--eval", f"{tmp_path}/entries", "--batch", "5"])
    assert readers.jsonl(spark, f"{tmp_path}/stage0/train").count() == 15
    jobs.main(["assemble", f"{tmp_path}/entries", f"{tmp_path}/out", "--eval", f"{tmp_path}/entries", "--eval-size", "2", "--batch", "4"])
    assert readers.jsonl(spark, f"{tmp_path}/out/eval").count() == 2
    jobs.main(["assemble", f"{tmp_path}/entries", f"{tmp_path}/again", "--eval", f"{tmp_path}/entries", "--existing-eval", f"{tmp_path}/out/eval", "--batch", "4", "--engineered", "--clean-synthetic", "--big-eval-size", "2"])
    ids = [{r.id for r in readers.jsonl(spark, f"{tmp_path}/{d}/eval").collect()} for d in ("out", "again")]
    assert ids[0] == ids[1] and readers.jsonl(spark, f"{tmp_path}/again/big_eval").count() == 2
    with pytest.raises(ValueError, match="no stat lines"):
        jobs.embeddings(spark, f"{tmp_path}/in/sub")
    q = incremental.prepare_stream(spark, f"{tmp_path}/in", f"{tmp_path}/streamed", f"{tmp_path}/state", jobs.Prepare("eval"), once=True)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/streamed").count() == 12
