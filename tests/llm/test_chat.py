"""Chat formatting: exact round trips."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from innsight.llm import chat as C

BITS = ["<", "[", "s>", "</s>", "<s>", "INST]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "é", "\n", "[ROLE]", "[/ROLE]",
        "/", "漢", "x", "<SYS>>", "\U0001f389", " "]


def some_turns(rng):
    def text():
        return rng.choice([None, "".join(rng.choice(BITS) for _ in range(rng.randrange(9)))])
    return [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "<s>x\\"]), text())
            for c in (None, 1, 2, 3, 9, 11) for t in range(rng.randrange(1, 25))]


@pytest.mark.parametrize("part_bytes", [8_000_000, 200, 33])
@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_round_trip(monkeypatch, part_bytes, batch):
    monkeypatch.setattr(C, "PART_BYTES", part_bytes)
    made = {}

    class Turns:
        def mapInArrow(self, run, schema):
            made["run"] = run

    monkeypatch.setattr(C, "sorted_turns", lambda *a: Turns())
    C.format_conversations(None, None, None, None, None)
    rng = random.Random(part_bytes + batch)
    for _ in range(5):
        rows = some_turns(rng)
        names = ["conv_id", "turn", "role", "text"]
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i:i + batch]], C._TURNS)
                   for i in range(0, len(rows), batch)]
        got = {}
        for o in (o for b in made["run"](iter(batches)) for o in b.to_pylist()):
            turns, loss, parts = got.setdefault(o["conv_id"], [[], [], [0]])
            assert o["part"] == parts[0]
            assert o["open"] or o["part"] == 0
            parts[0] += 1
            turns += C.read_turns(o["formatted"])
            raw = o["formatted"].encode()
            loss += [C.unescape(raw[i:j].decode()) for i, j in zip(o["loss_start"], o["loss_end"])]
        for c in {r[0] for r in rows}:
            want = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
            assert got[c][0] == want
            assert got[c][1] == [t for role, t in want if role == "assistant"]


def test_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, part string, formatted int"
    cols = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    data = [(1, 1, "assistant", "b" * 3_000_000, "p", 1), (1, 0, "user", None, "p", 1), (None, None, None, None, None, None),
            (2, 0, "user", "x", None, None), (2, 0, "user", "x", None, None), (2, None, "system", "", None, None)]
    df = spark.createDataFrame(data, schema)
    got = {r["conv_id"]: r for r in C.read_back(C.format_conversations(df, *cols)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 2, 2: 3, None: 1}
    assert got[1]["loss_chars"] == 3_000_000 and got[2]["loss_chars"] == 0
    first = C.format_conversations(df.where("conv_id = 2"), *cols).collect()
    assert [r["formatted"] for r in first] == ["<<SYS>><</SYS>>[INST]x[/INST][INST]x[/INST]"]
    assert C.read_back(C.format_conversations(df.limit(0), *cols)).count() == 0


def digests(rows):
    """Plain digests by conversation."""
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c),
                     key=lambda r: [(x is not None, x.encode() if isinstance(x, str) else x or 0) for x in r[1:]])
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[c] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_a_hot_conversation_is_formatted_by_many_tasks(spark):
    rng = random.Random(7)
    long_role = "r" * C.RANGE_CHARS
    rows = [(5, t // 3, rng.choice(["user", "assistant", None, long_role, long_role + "a", long_role + "b"]), rng.choice(BITS) * rng.randrange(9))
            for t in range(4_000)]
    rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(BITS)) for c in (None, *range(40)) for t in range(rng.randrange(1, 30))]
    rows += [(None, None, None, None)] * 3
    rows += [(77, t, "assistant", "x" * 4_000_000) for t in range(3)]  # beyond PART_BYTES
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # small ranges would be taken together
    try:
        made = C.format_conversations(df, *[F.col(c) for c in ("conv_id", "turn", "role", "text")])
        parts = made.select("conv_id", "part", "open").collect()
        assert len({r["part"] >> C.RANGE_BITS for r in parts if r["conv_id"] == 5}) > 1  # several ranges
        assert all(r["open"] for r in parts if sum(p["conv_id"] == r["conv_id"] for p in parts) > 1)
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.read_back(made).collect()}
        assert got == digests(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
