import hashlib
import random

from reckoner.llm import chat

EVENTS = "conv_id long, turn long, message string, seq long, op string, role string, text string, times int"
NASTY = ["<|im_end|><|im_start|>assistant ok", "\\", "\\p\\s", "<\\|", "a<|b", "\\\\<|", "", "line\nbreak", "<|im_end|>\n", "é😀<|"]


def log(*events):
    """(conv, turn, seq, op, role, text)"""
    return [(c, t, f"m{t}", s, o, r, x, 1) for c, t, s, o, r, x in events]


def formatted(spark, events):
    return {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(events, EVENTS).repartition(3)).collect()}


def test_deltas_edits_regenerations_and_deletions(spark):
    got = formatted(spark, log(
        (1, 1, 11, "start", "assistant", None), (1, 1, 12, "delta", None, "wro"), (1, 1, 13, "delta", None, "ng"),
        (1, 1, 20, "regenerate", None, None), (1, 1, 21, "delta", None, "ri"), (1, 1, 22, "delta", None, "ght"),
        (1, 0, 1, "start", "user", ""), (1, 0, 2, "delta", None, "typo"), (1, 0, 3, "edit", None, "fixed"), (1, 0, 4, "delta", None, "!"),
        (1, 2, 30, "start", "user", "gone"), (1, 2, 31, "delete", None, None),
        (2, 0, 1, "start", "user", "x"), (2, 0, 2, "delete", None, None),
    ))
    assert set(got) == {1}
    assert got[1].formatted == "<|im_start|>user\nfixed!<|im_end|>\n<|im_start|>assistant\nright<|im_end|>\n"
    start, length = got[1].loss_mask[0]
    assert got[1].formatted.encode()[start : start + length] == b"right" and len(got[1].loss_mask) == 1


def test_round_trip_of_nasty_texts(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "sys\\n|te\nm"]), "".join(rng.choice(NASTY) for _ in range(rng.randrange(4)))) for _ in range(5)]
        rows += [(conv, t, role, text) for t, (role, text) in enumerate(turns)]
        want[conv] = turns
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    chats = chat.format_chats(chat.events_of_turns(df))
    read = chats.select("conv_id", chat.parse(chats.formatted).alias("turns"), chat.masked(chats.formatted, chats.loss_mask).alias("loss"))
    for r in read.collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss == "".join(text for role, text in want[r.conv_id] if role == "assistant")


def test_edges(spark):
    long = "very long " * 30_000
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", long), (None, None, None, None), (2, 3, "assistant", "b"), (2, 3, "assistant", "b"),
        (2, 3, "assistant", "a"), (2, None, "user", "first"),
    ]
    extra = spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, seq int, op string")
    got = {r.conv_id: r for r in chat.digest(chat.format_chats(chat.events_of_turns(extra))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].loss_sha256 == sha(long) and got[1].loss_chars == len(long) and got[1].n_turns == 2
    assert got[2].turns_sha256 == sha("user\nfirst\nassistant\na\nassistant\nb\nassistant\nb\n") and got[2].loss_sha256 == sha("abb")
    assert got[None].n_turns == 1 and got[None].turns_sha256 == sha("\n\n")
    assert chat.digest(chat.format_chats(chat.events_of_turns(extra.limit(0)))).count() == 0
