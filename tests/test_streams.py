"""Growing log files as streams, and publishers of what they hold."""

import pytest
from pyspark.sql import functions as F

from weftline.streaming import publish as P
from weftline.streaming import tail as L

TRAINING = "[2023-01-01 00:00:0{i}] Ep. 1 : Up. {i} : Sen. 1,{i}00 : Cost 4.{i} : Time 9.5s : 100.00 words/s : gNorm 0.5"
VALID = "[2023-01-01 00:00:01] [valid] Ep. 1 : Up. {i} : {key} : {value} : new best"


class Rows(P.Publisher):
    def __init__(self):
        self.got = []

    def training(self, records, batch):
        self.got += [(r.epoch, r.up, r.cost) for r in records.collect()]

    def validation(self, records, batch):
        self.got += [(r.up, r.chrf, r.bleu_detok) for r in records.collect()]


class Broken(P.Publisher):
    def training(self, records, batch):
        raise RuntimeError("no network")


def drained(spark, folder, checkpoint):
    got = []
    q = L.tail(spark, folder).writeStream.foreachBatch(lambda b, _: got.extend((r.at, r.text) for r in b.collect())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(60)
    return sorted(got)


def test_tail_goes_on_where_it_stopped(spark, tmp_path):
    logs, log = tmp_path / "logs", tmp_path / "logs" / "a.log"
    logs.mkdir()
    log.write_bytes(b"one\r\ntwo\nthr")
    assert drained(spark, str(logs), str(tmp_path / "ck")) == [(0, "one"), (5, "two")]
    assert drained(spark, str(logs), str(tmp_path / "ck")) == []
    with log.open("ab") as f:
        f.write("ee\n\nfünf\n".encode())
    (logs / "b.log").write_bytes(b"new\n")
    assert drained(spark, str(logs), str(tmp_path / "ck")) == [(0, "new"), (9, "three"), (15, ""), (16, "fünf")]
    log.write_bytes(b"anew\n")
    assert drained(spark, str(logs), str(tmp_path / "ck")) == [(0, "anew")]


def test_last_line_end(tmp_path, monkeypatch):
    monkeypatch.setattr(L, "WINDOW", 4)
    path = tmp_path / "x"
    path.write_bytes(b"ab\ncdefghijkl")
    fs, at = L.pafs.FileSystem.from_uri(str(path))
    assert [L.last_line_end(fs, at, s, 13) for s in (0, 3, 5)] == [3, 3, 5]
    path.write_bytes(b"ab\ncdefghijkl\nx")
    reader = L.TailReader({"path": str(tmp_path)})
    batches = list(reader.read(L.Stretch(at, 0, 14)))
    assert [(r["at"], r["text"]) for b in batches for r in b.to_pylist()] == [(0, "ab"), (3, "cdefghijkl")]


def test_publish(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    values = {"chrf": 50.5, "ce-mean-words": 1.5, "bleu-detok": 30.0}
    lines = [TRAINING.format(i=i) for i in (1, 2)] + [VALID.format(i=2, key=k, value=v) for k, v in list(values.items())[:2]] + ["noise"]
    (logs / "t.log").write_text("\n".join(lines) + "\n")
    rows, folder = Rows(), str(tmp_path / "csv")
    sinks = [Broken(), rows, P.Csv(folder), P.Scalars(str(tmp_path / "sc"))]

    def run():
        for q in P.publish(L.tail(spark, str(logs)), sinks, str(tmp_path / "ck"), once=True):
            assert q.awaitTermination(60)
            assert q.exception() is None

    run()
    assert sorted(rows.got) == [(1, 1, 4.1), (1, 2, 4.2)]
    with (logs / "t.log").open("a") as f:
        f.write(VALID.format(i=2, key="bleu-detok", value=30.0) + "\n" + TRAINING.format(i=3) + "\n")
    run()
    assert sorted(rows.got) == [(1, 1, 4.1), (1, 2, 4.2), (1, 3, 4.3), (2, 50.5, 30.0)]
    assert spark.read.csv(f"{folder}/training", header=True).count() == 3
    got = {(r.tag, r.step): r.value for r in spark.read.parquet(str(tmp_path / "sc" / "train")).collect()}
    assert got["train/cost", 2] == 4.2 and got["train/sen", 1] == 1100.0


def test_failures_are_returned(spark):
    failed = P.each([Broken(), Rows()], "training", spark.range(0).select(F.lit(1).alias("epoch"), F.lit(1).alias("up"), F.lit(1.0).alias("cost")), 0)
    assert [n for n, _ in failed] == ["Broken"]
    with pytest.raises(AttributeError):
        raise P.each([Rows()], "nothing")[0][1]
