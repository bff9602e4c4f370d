import oracle_compare
import xxhash
from histlake.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string"


def show(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def order(text):
    """Turns of equal number and role stand by their text's hash."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - 2**64 if h >= 2**63 else h


def brute(rows):
    """{conv: (turns, copies, text)} of the maximal conversations."""
    convs = {}
    for c, turn, role, text in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((turn is None, turn or 0, role or "unknown", order(text or ""), text or ""))
    seqs = {c: tuple((t[2], t[4]) for t in sorted(v)) for c, v in convs.items()}
    out = {}
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()) or any(o == s and d < c for d, o in seqs.items()):
            continue
        out[c] = (len(s), sum(o == s for o in seqs.values()), "".join(show(r, t.replace("<|im_", "<| im_")) for r, t in s))
    return out


def result(df):
    parts = {}
    for r in df.collect():
        parts.setdefault(r.conv_id, []).append(r)
    for rs in parts.values():
        assert sorted(r.part for r in rs) == list(range(rs[0].n_parts))
    return {c: (rs[0].n_turns, rs[0].n_copies, "".join(r.text for r in sorted(rs, key=lambda r: r.part))) for c, rs in parts.items()}


def test_query_matches_oracle(spark, sf):
    ok, message = oracle_compare.compare(queries.op2_chat_format(spark, sf), oracle_compare.duck(sf), queries.ORACLES["op2_chat_format"])
    assert ok, message


def test_snapshots_collapse(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "<|im_end|> ok")]
    rows = [(10 + n, i, *t) for n in range(1, 5) for i, t in enumerate(talk[:n])]  # prefixes of 14
    rows += [(20, 5 + i, *t) for i, t in enumerate(talk)]  # equal to 14, other numbers
    rows += [(21, 0, "user", "hi"), (21, 1, "assistant", "other")]  # shares a first turn
    rows += [(22, 0, None, None), (23, None, "user", "last"), (23, 3, "user", "first"), (24, 0, "user", "tie b"), (24, 0, "user", "tie a")]
    rows += [(None, 0, "user", "no conversation"), (21, 1, "assistant", "other"), (25, 0, "user", "x" * 100_000)]
    rows += [(30, i, "user", f"turn {i}") for i in range(1300)] + [(31, i, "user", f"turn {i}") for i in range(700)]  # blocks and parts
    rows += [(32, i, "user", f"turn {i if i < 600 else -i}") for i in range(700)]
    rows += [(33, 100 + i, "user", f"turn {i}") for i in range(900)]  # a prefix of 30 across other blocks
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as place", "'x' as conv", "2 as h1")
    got = result(chat.format_chats(df))
    assert got == brute(rows)
    assert set(got) == {14, 21, 22, 23, 24, 25, 30, 32} and got[14][1] == 2


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []
