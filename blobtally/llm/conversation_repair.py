"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation becomes a sequence of symbols, one for each row: the initial of its role and its
fault. Edits turn the rows into ``(s?(ua)+)?``, an automaton of four states, and a symbol is a
transfer matrix over these states in the min-plus semiring whose elements are a cost and an audit
(the initials of the edits), ordered by cost, then by audit. No audit of a state pair is a prefix of
another of the same cost, as it has an initial for each row and insertions cost, so concatenation
keeps the order and matrices can be multiplied in any grouping.

Re-Pair finds the pairs of symbols that are most frequent over all conversations and makes each a
rule. A rule's matrix is the product of its two parts', computed once, bottom-up, with audits as ropes
that share their parts; every conversation that has the rule uses that matrix. Sequences are cut
into segments, so a conversation's length bounds no task, and the grammar changes what is
shared, never a result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobtally.llm.common import materialise

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Rows of a segment; rounds of the grammar, new rules in a round, and uses a rule has at least.
SEGMENT, ROUNDS, RULES_PER_ROUND, MIN_USES = 4096, 12, 256, 2
#: Pairs, and repaired sequences, that a task remembers at a time.
_REMEMBERED = 50_000

NONE, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = "sua-"  # the last stands for every other role
_SPACE = " \t\n\x0b\x0c\r"
#: States: nothing written, then the initial written last. The first and the last are complete.
START, SYSTEM, USER, ASSISTANT = range(4)
COMPLETE = (START, ASSISTANT)
_STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}


def symbol(initial: str, fault: int) -> str:
    return chr(ord("A") + 4 * INITIALS.index(initial) + fault)


class Rope:
    """An audit as a leaf of text or a pair of ropes, which are shared and never copied."""

    __slots__ = ("left", "right", "leaf")

    def __init__(self, leaf: str = "", left: Rope | None = None, right: Rope | None = None):
        self.leaf, self.left, self.right = leaf, left, right

    def __add__(self, other: Rope) -> Rope:
        if self.left is None and not self.leaf:
            return other
        if other.left is None and not other.leaf:
            return self
        return Rope(left=self, right=other)

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            x = todo.pop()
            if x.left is not None:
                todo += [x.right, x.left]
            elif x.leaf:
                yield x.leaf

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        a, b, mine, its = self.leaves(), other.leaves(), "", ""
        while True:
            mine, its = mine or next(a, ""), its or next(b, "")
            n = min(len(mine), len(its))
            if not n:
                return not mine and bool(its)
            if mine[:n] != its[:n]:
                return mine[:n] < its[:n]
            mine, its = mine[n:], its[n:]


Entry = tuple[int, Rope]
Matrix = dict[tuple[int, int], Entry]


def least(entries: Iterable[Entry]) -> Entry | None:
    best = None
    for e in entries:
        if best is None or e[0] < best[0] or e[0] == best[0] and e[1] < best[1]:
            best = e
    return best


def product(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product: the least way from each state over both parts to each state."""
    ways: dict[tuple[int, int], list[Entry]] = {}
    for (i, j), (cost, audit) in x.items():
        for k in range(4):
            if (j, k) in y:
                more, rest = y[j, k]
                ways.setdefault((i, k), []).append((cost + more, audit, rest))
    out = {}
    for at, found in ways.items():
        low = min(w[0] for w in found)
        out[at] = least((c, a + r) for c, a, r in found if c == low)
    return out


def insertions() -> Matrix:
    """What can be inserted at one place: nothing, a user, an assistant, or both in turn."""
    out = {(i, i): (0, Rope()) for i in range(4)}
    for i in (START, SYSTEM, ASSISTANT):
        out[i, USER] = (INSERT_COST, Rope(INSERT))
    out[USER, ASSISTANT] = (INSERT_COST, Rope(INSERT))
    for i in (START, SYSTEM):
        out[i, ASSISTANT] = (2 * INSERT_COST, Rope(2 * INSERT))
    return out


def row_matrix(initial: str, fault: int) -> Matrix:
    """Insertions before a row, then one edit of the row itself."""
    ways: dict[tuple[int, int], list[Entry]] = {(i, i): [(DELETE_COST, Rope(DELETE))] for i in range(4)}
    if fault in (NONE, TRUNCATED):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for i, j in _STEP.get(initial, {}).items():
            ways.setdefault((i, j), []).append((more, Rope(KEEP)))
        for role in "ua":
            for i, j in _STEP[role].items():
                ways.setdefault((i, j), []).append((more + REROLE_COST, Rope(REROLE)))
    return product(insertions(), {at: least(found) for at, found in ways.items()})


@dataclass
class Summary:
    """Faults of a stretch of rows: counts, and its ends for the pairs that cross them."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str

    def __add__(self, other: Summary) -> Summary:
        return Summary(self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
                       self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")), self.first, other.last)


class Grammar:
    """Rules over the row symbols, each with its matrix and its summary."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []  # (pair, symbol)
        self.matrix: dict[str, Matrix] = {}
        self.summary: dict[str, Summary] = {}
        self.texts: dict[str, list[tuple[int, int, int, str]]] = {}
        for initial in INITIALS:
            for fault in range(4):
                s = symbol(initial, fault)
                self.matrix[s] = row_matrix(initial, fault)
                self.summary[s] = Summary(*(int(fault == x) for x in (BLANK, DUPLICATE, TRUNCATED)), 0, initial, initial)

    def add(self, pair: str) -> None:
        s = chr(0x10000 + len(self.rules))
        self.rules.append((pair, s))
        self.matrix[s] = product(self.matrix[pair[0]], self.matrix[pair[1]])
        self.summary[s] = self.summary[pair[0]] + self.summary[pair[1]]

    def written(self, s: str) -> list[tuple[int, int, int, str]]:
        """A symbol's matrix as (from, to, cost, audit), the audits written out where they are first needed."""
        if s not in self.texts:
            self.texts[s] = [(i, j, cost, str(audit)) for (i, j), (cost, audit) in self.matrix[s].items()]
        return self.texts[s]


def compress(sequences: list[str], rules: list[tuple[str, str]]) -> list[str]:
    """Sequences with every rule applied in turn; the separator is part of no pair."""
    text = "\n".join(sequences)
    for pair, s in rules:
        text = text.replace(pair, s)
    return text.split("\n")


def pairs(sequence: str) -> Iterator[str]:
    """Neighbouring symbols; of a run of one symbol, pairs that do not overlap."""
    skip = False
    for a, b in zip(sequence, sequence[1:]):
        if a == b and skip:
            skip = False
            continue
        skip = a == b
        yield a + b


def learn(shapes: DataFrame) -> Grammar:
    """Re-Pair over distinct sequences ``shapes(symbols, uses)``, several rules a round.

    Pairs are counted where the sequences lie; a round brings ``RULES_PER_ROUND`` pairs to the driver.
    """
    grammar = Grammar()
    for _ in range(ROUNDS):
        rules = list(grammar.rules)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()

            def found() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["pair", "n"])

            for batch in batches:
                for s, uses in zip(compress(batch.column("symbols").to_pylist(), rules), batch.column("uses").to_pylist()):
                    for p in pairs(s):
                        seen[p] += uses
                    if len(seen) > _REMEMBERED:
                        yield found()
                        seen.clear()
            yield found()

        top = shapes.mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")) \
            .where(F.col("n") >= MIN_USES).orderBy(F.desc("n"), "pair").limit(RULES_PER_ROUND).collect()
        for r in top:
            grammar.add(r["pair"])
        if not top:
            break
    return grammar


class Fold:
    """A row vector of the semiring, moved over one conversation's symbols.

    What all states' audits begin with is settled and put aside, so only their ends are compared.
    """

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.open: dict[int, tuple[int, str]] = {START: (0, "")}
        self.summary: Summary | None = None

    def step(self, matrix: Iterable[tuple[int, int, int, str]]) -> None:
        ways: dict[int, tuple[int, str]] = {}
        for i, j, cost, audit in matrix:
            if i in self.open:
                way = (self.open[i][0] + cost, self.open[i][1] + audit)
                if j not in ways or way < ways[j]:
                    ways[j] = way
        same = len(commonprefix([a for _, a in ways.values()]))
        if same:
            self.settled.append(next(iter(ways.values()))[1][:same])
        self.open = {j: (c, a[same:]) for j, (c, a) in ways.items()}

    def over(self, symbols: str, grammar: Grammar) -> None:
        for s in symbols:
            self.step(grammar.written(s))
            self.summary = self.summary + grammar.summary[s] if self.summary else grammar.summary[s]

    def result(self) -> tuple:
        """(blank, duplicate, truncated, illegal, cost, audit)."""
        self.step((i, j, cost, str(audit)) for (i, j), (cost, audit) in insertions().items())
        cost, rest = min(self.open[s] for s in COMPLETE if s in self.open)
        x = self.summary or Summary(0, 0, 0, 0, "", "")
        return x.blank, x.duplicate, x.truncated, x.illegal, cost, "".join(self.settled) + rest


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, copies) after the damage that crc32(`conv_id:turn`) % 20 names.

    ``conv`` is the id as text. A null id, turn (in the checksum), role or text stands as one space.
    """
    space = F.lit(" ")
    conv = F.coalesce(F.col("conv_id").cast("string"), space)
    kind = F.crc32(F.concat(conv, F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        conv.alias("conv"), F.col("turn").cast("bigint").alias("turn"), kind.alias("_kind"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("copies"),
    ).where(F.col("_kind") != 0).drop("_kind")


def _ordered(rows: DataFrame) -> DataFrame:
    """Add the order inside a conversation: null turns first, then turn, role and the text's digest."""
    return rows.withColumns({"has": F.col("turn").isNotNull(), "at": F.coalesce("turn", F.lit(0).cast("bigint")),
                             "digest": F.md5("text")})


ORDER = ["conv", "has", "at", "role", "digest"]


def segments(rows: DataFrame) -> DataFrame:
    """(conv, part, place, symbols): every conversation's symbols in order, ``SEGMENT`` at most in a row.

    Equal rows are counted first, so one that is repeated without end is one row here. A row is a
    duplicate unless its turn is the least of its (conversation, role, text). Rows are then dealt by
    ranges of their order, so a long conversation is spread over tasks.
    """
    end = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    first = F.substring("role", 1, 1)
    counted = _ordered(rows).withColumns({
        "initial": F.when(first.isin("s", "u", "a"), first).otherwise("-"),
        "fault": F.when(end == "", BLANK).when(end.isin(".", "!", "?"), NONE).otherwise(TRUNCATED),
    }).groupBy(*ORDER, "initial", "fault").agg(F.sum("copies").alias("n"))
    earliest = counted.groupBy("conv", "role", "digest").agg(F.min(F.struct("has", "at")).alias("first"))
    marked = counted.join(earliest, ["conv", "role", "digest"]).withColumn("fault", F.when(
        (F.col("fault") != BLANK) & (F.struct("has", "at") != F.col("first")), DUPLICATE).otherwise(F.col("fault")))
    ranged = marked.select(*ORDER, "initial", "fault", "n").repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, place, held, out = None, 0, "", []

        def full(keep: int) -> None:
            nonlocal place, held
            while len(held) > keep:
                out.append((conv, part, place, held[:SEGMENT]))
                place, held = place + 1, held[SEGMENT:]

        def written() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv", "part", "place", "symbols"])
            out.clear()
            return done

        for batch in batches:
            for c, i, f, n in zip(*(batch.column(x).to_pylist() for x in ("conv", "initial", "fault", "n"))):
                if c != conv:
                    full(0)
                    conv = c
                held += symbol(i, f)
                again = symbol(i, f if f == BLANK else DUPLICATE)
                while n > 1:  # the rest of equal rows
                    more = min(n - 1, SEGMENT)
                    held, n = held + again * more, n - more
                    full(SEGMENT)
                full(SEGMENT)
            if out:
                yield written()
        full(0)
        if out:
            yield written()

    return ranged.select("conv", "initial", "fault", "n").mapInArrow(cut, "conv string, part bigint, place bigint, symbols string")


FOUND = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_FOUND_TYPES = [*[pa.int64()] * 5, pa.string()]
_FOUND_DDL = ", ".join(f"{c} bigint" for c in FOUND[:5]) + ", audit string"


def cheapest_edits(cut: DataFrame, grammar: Grammar) -> DataFrame:
    """(conv, fault counts, cost, audit) of every conversation of ``segments``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, fold, parts = None, Fold(), []
        known: dict[tuple[str, ...], tuple] = {}

        def closed() -> tuple:
            """The result of the open conversation; one of a single segment is looked up."""
            if parts:
                if parts[0] not in known:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    fold.over(parts[0], grammar)
                    known[parts[0]] = fold.result()
                return (conv, *known[parts[0]])
            return (conv, *fold.result())

        def written(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), *_FOUND_TYPES])], names=["conv", *FOUND])

        for batch in batches:
            out = []
            for c, s in zip(batch.column("conv").to_pylist(), compress(batch.column("symbols").to_pylist(), grammar.rules)):
                if c != conv:
                    if conv is not None:
                        out.append(closed())
                    conv, fold, parts = c, Fold(), [s]
                    continue
                if parts:
                    fold.over(parts.pop(), grammar)
                fold.over(s, grammar)
            if out:
                yield written(out)
        if conv is not None:
            yield written([closed()])

    return cut.repartition("conv").sortWithinPartitions("conv", "part", "place").select("conv", "symbols") \
        .mapInArrow(run, f"conv string, {_FOUND_DDL}")


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The rows (role, text) after the edits of an audit. Where a row is rewritten or inserted its role
    follows from what was written before it."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit in (REROLE, INSERT):
            role = "assistant" if state == USER else "user"
        state = _STEP[role[0]][state]
        yield role, text


def _digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Apply every conversation's audit to its rows, as a stream in their order."""
    both = found.select("conv", F.lit(True).alias("has"), F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("text"),
                        F.lit(0).cast("bigint").alias("copies"), "gaps", *FOUND, F.lit(0).alias("kind"))
    of_rows = _ordered(rows).select("conv", "has", "at", "role", "digest", "text", "copies", F.lit(None).cast("bigint").alias("gaps"),
                                    *[F.lit(None).cast("string" if c == "audit" else "bigint").alias(c) for c in FOUND], F.lit(1).alias("kind"))
    sent = ["conv", "role", "text", "copies", "gaps", *FOUND, "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in sent))

        source, ahead = stream(), []

        def rows_of(conv: str) -> Iterator[tuple[str, str]]:
            for r in source:
                if r[0] != conv or r[-1] == 0:
                    ahead.append(r)
                    return
                for _ in range(r[3]):
                    yield r[1], r[2]

        names = ["conv", "gaps", *FOUND, "repaired_sha256"]
        types = [pa.string(), pa.int64(), *_FOUND_TYPES, pa.string()]
        while head := ahead.pop() if ahead else next(source, None):
            if head[-1]:
                raise RuntimeError(f"conversation {head[0]} has rows but no audit")
            hashed, begun, rest = hashlib.sha256(), False, rows_of(head[0])
            for role, text in repaired(head[-2], rest):
                hashed.update(f"{chr(10) if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
            for _ in rest:
                raise RuntimeError(f"conversation {head[0]} has more rows than its audit")
            done.append((head[0], *head[4:-1], hashed.hexdigest()))
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return both.unionByName(of_rows).repartition("conv").sortWithinPartitions("conv", "kind", "has", "at", "role", "digest") \
        .select(*sent).mapInArrow(run, f"conv string, gaps bigint, {_FOUND_DDL}, repaired_sha256 string")


def _gaps(conversations: DataFrame) -> DataFrame:
    """Turns missing between the least and the greatest of every conversation, after the damage."""
    every = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    wide = "decimal(20,0)"
    turns = damage(conversations).select("conv", "turn").distinct().groupBy("conv").agg(
        (F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn")).try_cast("bigint").alias("gaps"),
        F.count("turn").alias("n"))
    return every.join(turns, "conv", "left").select("conv", F.when(F.coalesce("n", F.lit(0)) == 0, 0).otherwise(F.col("gaps")).alias("gaps"))


def repair(conversations: DataFrame) -> DataFrame:
    """Damage and repair ``conversations(conv_id long, turn long, role, text)``; other columns are ignored.

    Returns one row per conv_id: gaps, blank, duplicate, truncated, illegal, cost (long), audit (initials of
    the cheapest edits, the ASCII-least of them) and repaired_sha256.

    Rows of a conversation go by turn (nulls first), those of one turn by role and then by the md5 of the
    text, so equal rows stand together. A null id is a conversation of its own; null role and text are one
    space, which is no role initial and a blank text. A role counts by its first character. Gaps beyond a
    long are null. A conversation that loses all rows has zeros, an empty audit and the hash of nothing; an
    empty table gives an empty result. Only the hash of a conversation, which is sequential, is computed
    by one task, over a stream.
    """
    rows = damage(conversations)
    cut = materialise(segments(rows), "segments")
    shapes = materialise(cut.groupBy("symbols").agg(F.count(F.lit(1)).alias("uses")), "shapes")
    edits = cheapest_edits(cut, learn(shapes))
    found = _gaps(conversations).join(edits, "conv", "left").fillna(0, FOUND[:5]).fillna("", ["audit"])
    out = _digests(rows, found)
    conv_id = F.when(F.col("conv") != " ", F.col("conv")).cast("bigint")
    return out.select(conv_id.alias("conv_id"), "gaps", *FOUND, "repaired_sha256")
