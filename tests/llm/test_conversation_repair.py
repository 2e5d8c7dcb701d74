import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import conversation_repair as C
from strata.llm.queries import op11_conversation_repair

PATTERN = re.compile(r"(s?(ua)+)?")
BARE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired rows) from rows (role, text, fault): least (cost,
    audit) for each sequence of initials so far, folded to its state."""
    state_of = lambda s: "" if not s else s[-1]
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}

    def insert(best):
        for _ in range(3):
            for s, (cost, audit, out) in list(best.items()):
                new = allowed[s][-1]
                offer = (cost + 2, audit + "I", out + (("user" if new == "u" else "assistant", ""),))
                if new not in best or offer[:2] < best[new][:2]:
                    best[new] = offer
        return best

    best = insert({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, out) in best.items():
            offers = [(s, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in allowed[s]:
                    offers.append((role[0], (cost + extra, audit + "K", out + ((role, text),))))
                new = allowed[s][-1]
                offers.append((new, (cost + 2 + extra, audit + "R", out + (("user" if new == "u" else "assistant", text),))))
            for to, offer in offers:
                if to not in after or offer[:2] < after[to][:2]:
                    after[to] = offer
        best = insert(after)
    assert state_of("") == ""
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def plain(conversations):
    groups = {}
    for conv, turn, role, text in conversations:
        rows = groups.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        rows += [(turn, role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            chars = BARE.findall(text)
            faults.append("blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit, repaired = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults)])
        assert PATTERN.fullmatch("".join(r[0] for r, _ in repaired))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*C.DIGESTS_ARROW.names).collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("lit") for c in ("segment", "copies", "audit", "symbols", "kind", "fate")})


KINDS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["", "blank", "truncated"])), max_size=14)


def symbols_of(rows):
    return bytes(C.MUST_GO if fault == "blank" else 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == "truncated") for role, fault in rows)


@settings(max_examples=500, deadline=None)
@given(KINDS)
def test_block_tables_equal_the_plain_search(rows):
    cost, audit = C.repair(symbols_of(rows))
    want = cheapest([(role, "x", fault) for role, fault in rows])
    assert (cost, audit) == want[:2]
    assert tuple(C.repaired_rows(audit, iter([(r, "x") for r, _ in rows]))) == want[2]


@settings(max_examples=200, deadline=None)
@given(KINDS, KINDS, KINDS)
def test_segments_join_to_the_whole(a, b, c):
    parts = [symbols_of(p) for p in (a, b, c)]
    behind, ways = C.END_VECTOR, []
    for symbols in reversed(parts):
        inner, vector, cost = C.vectors_behind(symbols, behind)
        ways.insert(0, [C.trace(symbols, inner, q) for q in range(4)])
        before = C.before_segment(C.segment_matrix(symbols), behind)
        assert before == tuple(min(C.FREE, x + cost) for x in vector)
        behind = before
    state, audit = C.START, ""
    for way in ways:
        edits, state = way[state]
        audit += edits
    assert (behind[C.START], audit + C.end_edits(state)) == C.repair(b"".join(parts))


ODD = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 1, "assistant", " \t"), (1, 2, "tool", "x?\n "),
       (2, None, "user", None), (None, None, None, None), (None, 3, "user", "Yes."), (None, 4, "assistant", "No"), (3, 5, "", "text!"),
       (4, 0, "system", "S."), (4, 0, "user", "a."), (4, 0, "user", "b."), (4, 0, "assistant", "c."), (4, 9, "assistant", "a" * 70000 + " 日本!  "),
       *((5, t, "user" if t % 2 else "assistant", "same.") for t in range(40)), *((i, 0, "user", "only") for i in range(100, 160))]


def test_odd_rows_against_plain_version(spark):
    assert rows_of(C.repair_conversations(make(spark, ODD))) == plain(ODD)


def test_long_conversation_in_many_segments(spark):
    rows = [(7, t // 2 if t % 11 else None, ("user", "assistant", "system", "tool")[t * t % 5 % 4], f"text {t % 90}{'.' * (t % 3)}") for t in range(3000)]
    rows += [(i, t, "user", "Hm.") for i in (6, 8) for t in range(3)]
    df = make(spark, rows).repartition(4)
    cut = C.segments(C.short_rows(C.damaged(df)), 9)
    assert cut.filter("conv_id = 7").count() > 2
    assert rows_of(C.repair_conversations(df, 9)) == plain(rows)


def test_empty_table(spark):
    assert C.repair_conversations(make(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_plain_version(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op11_conversation_repair(spark, path)) == plain(rows)
