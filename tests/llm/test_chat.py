import hashlib
import random

from voxelweave.llm import chat as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, Turns int, EXAMPLE int"


def want(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((-(10**9) if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def conversations():
    rnd = random.Random(4)
    parts = [*C.CONTROL, "\\", "\\\\", "\n", "é", "😀", "<", "|", "[", "/INST]", "a", " ", "$1", "<|", "|>"]
    text = lambda: "".join(rnd.choices(parts, k=rnd.randint(0, 12)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", text()]), text()) for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(100, 0, None, None), (101, None, "assistant", "x"), (101, 1, "assistant", None), (None, 0, "user", "who"), (102, 0, "user", "same"), (102, 0, "user", "same"), (103, 0, "user", "a"), (103, 1, "assistant", "b" * 200_000)]
    return rows


def test_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    examples = C.expand(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digest(examples).collect()}
    assert got == want(rows)
    kept = examples.collect()
    assert {r.conv_id: r.formatted_chars for r in C.digest(examples).collect()} == {c: sum(len(e.formatted) for e in kept if e.conv_id == c) for c in got}
    replies = sum(r[2] == "assistant" for r in rows)
    assert sum(e.formatted[: e.loss_start].endswith(f"{C.TURN}assistant{C.TEXT}") for e in kept) == replies
    for e in kept:  # marks are only where the template puts them
        assert e.formatted.count(C.TURN) == e.formatted.count(C.TEXT) == e.formatted.count(C.END)
        assert not any(m in e.formatted for m in C.CONTROL if m not in (C.TURN, C.TEXT, C.END))


def test_each_reply_is_trained_once_with_its_context(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "first"), (1, 3, "user", "r"), (1, 4, "assistant", "second"), (1, 5, "user", "end")]
    out = sorted(C.expand(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect(), key=lambda e: e.example)
    assert [e.formatted[e.loss_start : e.loss_start + e.loss_length] for e in out] == ["first", "second", ""]
    assert out[1].formatted.startswith(out[0].formatted) and out[2].formatted.startswith(out[1].formatted)


def test_empty(spark):
    assert C.digest(C.expand(spark.createDataFrame([], SCHEMA))).count() == 0
