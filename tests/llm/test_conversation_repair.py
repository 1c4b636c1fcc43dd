"""Conversation repair against a plain dynamic program over every conversation."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import types as T

from blobtally.llm import conversation_repair as cr

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("conv", T.StringType())])
sys.setrecursionlimit(20_000)  # the plain program recurses over rows
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit) over rows (initial, fault), by trying every edit at every row and state."""
    @lru_cache(None)
    def best(i, last, inserts):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if inserts < 2:
            for new in "ua":
                if (last, new) in NEXT:
                    ways.append((3, "I", best(i, new, inserts + 1)))
        if i < len(rows):
            initial, fault = rows[i]
            more = 3 if fault == "truncated" else 0
            ways.append((4, "D", best(i + 1, last, 0)))
            if fault in ("", "truncated"):
                if (last, initial) in NEXT:
                    ways.append((more, "K", best(i + 1, initial, 0)))
                ways += [(3 + more, "R", best(i + 1, new, 0)) for new in "ua" if (last, new) in NEXT]
        ways = [w if len(w) == 2 else (w[0] + w[2][0], w[1] + w[2][1]) for w in ways if len(w) == 2 or w[2]]
        return min(ways, default=None)

    return best(0, "", 0)


def slow_repair(table):
    """The contract in plain Python: {conv_id: row}."""
    convs, out = {}, {}
    for conv_id, turn, role, text in table:
        rows = convs.setdefault(conv_id, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv_id, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in rows if t is not None}
        seen, faults = set(), []
        for _, role, text in rows:
            found = SPACE.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "" if found[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role[:1], fault))
        cost, audit = cheapest(tuple(faults))
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(faults, faults[1:]))
        left, state, lines = iter(rows), "", []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit != "D":
                if edit in "IR":
                    role = "assistant" if state == "u" else "user"
                state = role[0]
                lines.append(f"{role}:{text}")
        n = [sum(f == x for _, f in faults) for x in ("blank", "duplicate", "truncated")]
        out[conv_id] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *n, illegal, cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, table, monkeypatch=None):
    df = spark.createDataFrame([(*r, "mine", "mine") for r in table], SCHEMA).repartition(5)
    out = cr.repair(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r["conv_id"]: tuple(r)[1:] for r in out.collect()}
    want = slow_repair(table)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], (k, got[k], want[k])
    return got


def test_row_matrices_and_products():
    """Any grouping of the product gives the least cost and audit of the plain program."""
    rng = random.Random(1)
    for _ in range(300):
        rows = [(rng.choice("suat"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 9))]
        code = {"": cr.NONE, "truncated": cr.TRUNCATED, "blank": cr.BLANK, "duplicate": cr.DUPLICATE}
        parts = [cr.row_matrix(i if i in "sua" else "-", code[f]) for i, f in rows] + [cr.insertions()]
        while len(parts) > 1:
            at = rng.randrange(len(parts) - 1)
            parts[at:at + 2] = [cr.product(parts[at], parts[at + 1])]
        cost, audit = cr.least(parts[0][0, j] for j in cr.COMPLETE if (0, j) in parts[0])
        assert (cost, str(audit)) == cheapest(tuple(rows))


def test_pairs_of_a_run_do_not_overlap():
    assert list(cr.pairs("aaaab")) == ["aa", "aa", "ab"] and list(cr.pairs("aaa")) == ["aa"] and list(cr.pairs("a")) == []
    x, y = cr.Rope("KK") + cr.Rope("D"), cr.Rope("K") + (cr.Rope("K") + cr.Rope("I"))
    assert x < y and not y < x and not x < x and str(cr.Rope() + x) == "KKD" and cr.Rope() < x


@pytest.fixture(scope="module")
def table():
    rng = random.Random(8)
    words = ["yes.", "no", "ok!", " \t", "", "why?  ", "a b c", "fine.\n", "é ü", None]
    rows = []
    for conv in range(120):
        turn = 0
        for _ in range(rng.randint(1, 14)):
            turn += rng.choice([1, 1, 1, 1, 2, 5])
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            rows.append((conv, turn, role, rng.choice(words) if rng.random() < 0.4 else f"text {rng.random()}" + rng.choice([".", ""])))
    rows += [(1000, None, "user", "hi."), (1000, None, "assistant", "yes."), (1000, 3, "user", "hi."), (1001, None, None, None),
             (None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, 5, "assistant", "b."), (-4, -7, "system", "x."), (-4, 9, "user", "y")]
    rows += [(2000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(500)]  # one long conversation
    rows += [(2001, 4, "user", "again.")] * 50 + [(2001, 5, "assistant", "same.")] * 3  # equal rows
    rows += [(3000 + i, 0, "user", "only.") for i in range(40)]  # some lose their only row
    rows += [(4000, t, "user", "copy.") for t in range(60)]
    return rows


def test_repair_against_the_plain_program(spark, table):
    got = check(spark, table)
    assert any(v[6] == "" for v in got.values()) and any(v[0] > 0 for v in got.values())


def test_segments_and_few_rules(spark, table, monkeypatch):
    """Short segments, no rules, or very few memories: the same results."""
    monkeypatch.setattr(cr, "SEGMENT", 7)
    monkeypatch.setattr(cr, "_REMEMBERED", 3)
    check(spark, table)
    monkeypatch.setattr(cr, "ROUNDS", 0)
    check(spark, table)


def test_given_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    check(spark, [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])


def test_rules_are_shared(spark):
    """Frequent sequences become rules: a long regular conversation is a few symbols."""
    shapes = spark.createDataFrame([("EI" * 64, 10), ("EIEIEI", 500)], "symbols string, uses bigint")
    grammar = cr.learn(shapes)
    short = cr.compress(["EI" * 64], grammar.rules)[0]
    assert len(short) <= 2 and grammar.rules[0][0] == "EI"
    assert grammar.matrix[short[0]][0, cr.ASSISTANT][0] == 0


def test_empty_table(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).count() == 0
