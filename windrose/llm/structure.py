"""Repair of conversation structure by weighted interval parsing (operator 13).

A legal conversation is ``(s?(ua)+)?``: an optional system turn, then user and
assistant turns in pairs.  The repair grammar is in Chomsky normal form: a
nonterminal [p q] spans edits that lead the structure from state p to state q, a
binary rule [p q] -> [p r] [r q] for every r, and each row derives the
nonterminals of its edits (keep, rerole, delete) closed under insertions on both
sides.  A cell holds the least (cost, audit) of each nonterminal over a span,
and cells are combined bottom-up by span length.  Every split of a span has a
rule for every middle state, so any one split gives the cell's least pair, and
spans double in length instead of starting at every row.

Audits of equal cost over one span are never proper prefixes of one another (a
longer one has more insertions, which cost), so the least pair of a span is made
of least pairs.  The audit alone fixes the result: in a legal conversation of
odd length the first turn is the kept system turn, and the others alternate.

A conversation of any length is cut into chunks of CHUNK rows; chunks are parsed
independently and merged MERGE at a time.  The digest of a repaired conversation
is a stream over its sorted rows with constant memory.

Defined cases: a null role or text counts as one space (a null text is blank);
rows without a turn come first; rows of one turn are ordered by role and text
digest; a null conv_id is one more conversation; a text of any length is one
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from windrose.llm.common import materialise, prepare
from windrose.llm.places import numbered

CHUNK = 64
MERGE = 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = "\t\n\x0b\x0c\r "
ENDS = ".!?"
NAMES = {"u": "user", "a": "assistant"}

# ------------------------------------------------------------ grammar
# states: 0 nothing yet, S after the system turn, U after a user turn, A after an assistant turn
STATES = "0SUA"
STEPS = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
FINAL = "0A"
Cell = dict[str, tuple[int, str]]   # nonterminal "pq" -> least (cost, audit)


def joined(left: Cell, right: Cell) -> Cell:
    """Cell of a span from the cells of its two parts, by the rules [p q] -> [p r] [r q]."""
    out: Cell = {}
    for pr, (c1, a1) in left.items():
        for rq, (c2, a2) in right.items():
            if pr[1] == rq[0]:
                name, pair = pr[0] + rq[1], (c1 + c2, a1 + a2)
                if name not in out or pair < out[name]:
                    out[name] = pair
    return out


def _closure() -> Cell:
    """The least insertions that lead from one state to another, none included."""
    cell: Cell = {p + p: (0, "") for p in STATES}
    one = {p + q: (INSERT, "I") for (p, i), q in STEPS.items() if i in NAMES}
    while True:
        more = joined(cell, {**one, **{p + p: (0, "") for p in STATES}})
        if more == cell:
            return cell
        cell = more


INSERTED = _closure()


def terminal(letter: str) -> Cell:
    """Cell of one row: its edits between insertions.

    Letters: s, u, a, x (another initial) for a sound row, S, U, A, X for a
    truncated one, 1, 2, 3, 4 for a row that must go.
    """
    edits: Cell = {p + p: (DELETE, "D") for p in STATES}
    if letter not in "1234":
        extra = TRUNCATED if letter.isupper() else 0
        for (p, initial), q in STEPS.items():
            options = [(extra, "K")] if initial == letter.lower() else []
            options += [(REROLE + extra, "R")] if initial in NAMES else []
            if options:
                edits[p + q] = min(options)
    return joined(joined(INSERTED, edits), INSERTED)


def combined(cells: list[Cell]) -> Cell:
    """Cell of a row of neighbouring spans, by doubling span lengths."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0]


@functools.lru_cache(1 << 14)
def _short(letters: str) -> Cell:
    """Cell of a span of at most 8 rows; conversations repeat these, so they are kept."""
    if len(letters) == 1:
        return terminal(letters)
    half = 1 << (len(letters) - 1).bit_length() - 1
    return joined(_short(letters[:half]), _short(letters[half:]))


def parse(letters: str) -> Cell:
    """Cell of a whole chunk."""
    return combined([_short(letters[i:i + 8]) for i in range(0, len(letters), 8)])


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[n] for n in ("0" + q for q in FINAL) if n in cell)


_SPEAKER = dict(zip("suaxSUAX1234", "suax" * 3))


def illegal_pair(first: str, second: str) -> bool:
    return _SPEAKER[first] + _SPEAKER[second] not in ("su", "ua", "au")


# ------------------------------------------------------------ rows and letters

def _letters(rows: DataFrame) -> DataFrame:
    """(conv, place, of, turn, role, text, fault, letter): rows in order with their first fault."""
    base = rows.select(F.struct(F.col("conv_id").alias("id")).alias("conv"), F.col("turn").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    base = base.withColumn("same", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    placed = materialise(numbered(base, "conv", [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("same").asc()],
                                  "structure-sorted"), "structure-rows")
    again = (placed.groupBy("conv", "same").agg(F.min("place").alias("seen"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    first = F.substring("role", 1, 1)
    number = F.when(first.isin("s", "u", "a"), F.instr(F.lit("sua"), first)).otherwise(4)
    return (placed.join(again, ["conv", "same"], "left")
            .withColumn("fault", F.when(last == "", "blank").when(F.col("place") > F.col("seen"), "duplicate")
                        .when(~last.isin(*ENDS), "truncated"))
            .withColumn("letter", F.when(F.col("fault").isin("blank", "duplicate"), number.cast("string"))
                        .when(F.col("fault") == "truncated", F.substring(F.lit("SUAX"), number, F.lit(1)))
                        .otherwise(F.substring(F.lit("suax"), number, F.lit(1)))))


def _parsed(conv: StructField):
    """(conv, span, of, letters) -> (conv, span, of, ends, illegal, names, costs, audits)."""
    schema = StructType([conv, StructField("span", LongType()), StructField("of", LongType()), StructField("ends", StringType()),
                         StructField("illegal", LongType()), StructField("names", ArrayType(StringType())),
                         StructField("costs", ArrayType(LongType())), StructField("audits", ArrayType(StringType()))])

    def run(batches):
        for b in batches:
            ends, illegal, cells = [], [], []
            for s in b.column(3).to_pylist():
                ends.append(s[0] + s[-1])
                illegal.append(sum(map(illegal_pair, s, s[1:])))
                cells.append(parse(s))
            yield _cell_batch([b.column(0), b.column(1), b.column(2)], ends, illegal, cells)

    return run, schema


def _cell_batch(head: list[pa.Array], ends: list[str], illegal: list[int], cells: list[Cell]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*head, pa.array(ends, pa.string()), pa.array(illegal, pa.int64()),
         pa.array([list(c) for c in cells], pa.list_(pa.string())),
         pa.array([[v[0] for v in c.values()] for c in cells], pa.list_(pa.int64())),
         pa.array([[v[1] for v in c.values()] for c in cells], pa.list_(pa.string()))],
        ["conv", "span", "of", "ends", "illegal", "names", "costs", "audits"])


def _merged(batches):
    """(conv, span, of, parts) -> the cell of the parts' joined span."""
    for b in batches:
        ends, illegal, cells = [], [], []
        for parts in b.column(3).to_pylist():
            ends.append(parts[0]["ends"][0] + parts[-1]["ends"][1])
            illegal.append(sum(p["illegal"] for p in parts)
                           + sum(illegal_pair(p["ends"][1], q["ends"][0]) for p, q in zip(parts, parts[1:])))
            cells.append(combined([dict(zip(p["names"], zip(p["costs"], p["audits"]))) for p in parts]))
        yield _cell_batch([b.column(0), b.column(1), b.column(2)], ends, illegal, cells)


def _plans(lettered: DataFrame) -> DataFrame:
    """(conv, of, illegal, cost, audit) for every conversation."""
    conv = lettered.schema["conv"]
    chunks = (lettered.groupBy("conv", F.expr(f"place div {CHUNK}").alias("span"))
              .agg(F.first("of").alias("of"), F.array_sort(F.collect_list(F.struct("place", "letter")))["letter"].alias("l"))
              .select("conv", "span", "of", F.array_join("l", "").alias("letters")))
    run, schema = _parsed(conv)
    cells = materialise(chunks.mapInArrow(run, schema), "structure-cells")
    spans = F.ceil(F.col("of") / CHUNK)
    longest = cells.agg(F.max(spans)).first()[0] or 0
    # conversations of one chunk are done; the others are merged until they have one span
    rounds, width = [cells.filter(spans == 1)], 1
    cells = cells.filter(spans > 1)
    while width < longest:
        width *= MERGE
        part = F.struct("span", "ends", "illegal", "names", "costs", "audits")
        groups = (cells.groupBy("conv", F.expr(f"span div {MERGE}").alias("up"))
                  .agg(F.first("of").alias("of"), F.array_sort(F.collect_list(part)).alias("parts"))
                  .select("conv", F.col("up").alias("span"), "of", "parts"))
        cells = materialise(groups.mapInArrow(_merged, schema), "structure-cells")
        rounds.append(cells.filter(spans <= width))
        cells = cells.filter(spans > width)

    def chosen(batches):
        for b in batches:
            pairs = [best(dict(zip(n, zip(c, a)))) for n, c, a in zip(*(b.column(i).to_pylist() for i in (5, 6, 7)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(4), pa.array([c for c, _ in pairs], pa.int64()),
                                              pa.array([a for _, a in pairs], pa.string())],
                                             ["conv", "of", "illegal", "cost", "audit"])

    done = functools.reduce(DataFrame.unionByName, rounds)
    return materialise(done.mapInArrow(chosen, StructType([
        conv, *(StructField(c, LongType()) for c in ("of", "illegal", "cost")), StructField("audit", StringType())])), "structure-plans")


def slices_of(audit: str, chunk: int = CHUNK) -> list[tuple[int, str, int]]:
    """(chunk number, edits, turns put out before): an audit cut where its chunks of rows end."""
    out, begin, rows, put, before = [], 0, 0, 0, 0
    for i, e in enumerate(audit):
        put += e != "D"
        rows += e != "I"
        if e != "I" and rows % chunk == 0:
            out.append((rows // chunk - 1, audit[begin:i + 1], before))
            begin, before = i + 1, put
    if begin < len(audit):
        if rows % chunk:
            out.append((rows // chunk, audit[begin:], before))
        else:     # nothing but insertions after the last full chunk
            n, edits, at = out.pop()
            out.append((n, edits + audit[begin:], at))
    return out


def _sliced(plans: DataFrame) -> DataFrame:
    """(conv, span, edits, before, turns): what each chunk's rows become; turns of the whole."""
    schema = StructType([plans.schema["conv"], StructField("span", LongType()), StructField("edits", StringType()),
                         StructField("before", LongType()), StructField("turns", LongType())])

    def run(batches):
        for b in batches:
            owner, rows = [], []
            for i, audit in enumerate(b.column(1).to_pylist()):
                turns = len(audit) - audit.count("D")
                for s in slices_of(audit):
                    owner.append(i)
                    rows.append((*s, turns))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.int64())], ["conv", "span", "edits", "before", "turns"])

    return plans.select("conv", "audit").mapInArrow(run, schema)


class _Script:
    """The edits of one chunk, taken row by row; yields (edit, role, text) of the turns put out."""

    def __init__(self, edits: str, before: int, turns: int):
        self.edits, self.at, self.put, self.odd = edits, 0, before, turns % 2

    def _role(self) -> str:
        return NAMES["ua"[(self.put - self.odd) % 2]]

    def inserted(self):
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            yield "I", self._role(), ""
            self.at += 1
            self.put += 1

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield edit, role if edit == "K" else self._role(), text
            self.put += 1


def _walk(batches):
    """(conv array, row, kind, edit, role, text) along rows sorted by conversation, chunk
    and place, each chunk led by its script; kind is "begin" once for a conversation."""
    script = current = None
    for b in batches:
        conv = b.column(0)
        names = conv.to_pylist()
        what, role, text, edits, before, turns = (b.column(i).to_pylist() for i in (2, 4, 5, 6, 7, 8))
        for i, name in enumerate(names):
            if what[i] == 0:
                if script:
                    yield from ((None, 0, "turn", *t) for t in script.inserted())
                if name != current:
                    yield conv, i, "begin", None, None, None
                    current = name
                script = _Script(edits[i], before[i], turns[i])
            else:
                yield from ((None, 0, "turn", *t) for t in script.row(role[i], text[i]))
    if script:
        yield from ((None, 0, "turn", *t) for t in script.inserted())


def _scripted(lettered: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows and the scripts of their chunks, each conversation in one partition in order."""
    none = lambda kind: F.lit(None).cast(kind)
    scripts = _sliced(plans).select("conv", "span", F.lit(0).alias("what"), F.lit(0).cast("long").alias("place"),
                                    none("string").alias("role"), none("string").alias("text"), "edits", "before", "turns")
    rows = lettered.select("conv", F.expr(f"place div {CHUNK}").alias("span"), F.lit(1).alias("what"), "place", "role", "text",
                           none("string").alias("edits"), none("long").alias("before"), none("long").alias("turns"))
    return scripts.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "span", "what", "place")


def _digests(scripted: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of each conversation's repaired ``role:text`` lines."""
    def run(batches):
        owner = sha = None
        turns = 0
        for conv, i, kind, _, role, text in _walk(batches):
            if kind == "begin":
                if owner is not None:
                    yield pa.RecordBatch.from_arrays([owner, pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])
                owner, sha, turns = conv.slice(i, 1), hashlib.sha256(), 0
            else:
                sha.update(f"{chr(10) if turns else ''}{role}:{text}".encode())
                turns += 1
        if owner is not None:
            yield pa.RecordBatch.from_arrays([owner, pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])

    return scripted.mapInArrow(run, StructType([scripted.schema["conv"], StructField("repaired_sha256", StringType())]))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, edit, role, text), edit one of K, R, I."""
    prepare(rows.sparkSession)
    lettered = materialise(_letters(rows), "structure-letters")
    scripted = _scripted(lettered, _plans(lettered))

    def run(batches):
        owner, position, held = None, 0, []

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.concat_arrays([h[0] for h in held]), *(pa.array([h[k] for h in held], t)
                                                           for k, t in ((1, pa.int64()), (2, pa.string()), (3, pa.string()), (4, pa.string())))],
                ["conv", "position", "edit", "role", "text"])
            held.clear()
            return batch

        for conv, i, kind, edit, role, text in _walk(batches):
            if kind == "begin":
                owner, position = conv.slice(i, 1), 0
            else:
                held.append((owner, position, edit, role, text))
                position += 1
                if len(held) >= 1000:
                    yield out()
        if held:
            yield out()

    return scripted.mapInArrow(run, StructType([
        scripted.schema["conv"], StructField("position", LongType()),
        *(StructField(c, StringType()) for c in ("edit", "role", "text"))])).select("conv.id", "position", "edit", "role", "text") \
        .withColumnRenamed("id", "conv_id")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    One row for each conversation of ``rows``, or for each conv_id of ``ids``
    (zeros, an empty audit and the empty text's digest where it has no rows).
    """
    prepare(rows.sparkSession)
    lettered = materialise(_letters(rows), "structure-letters")
    plans = _plans(lettered)
    fault = lambda name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
    # turns are counted once a conversation and turn first, so a long conversation stays spread
    turns = (lettered.groupBy("conv", "turn").agg(fault("blank"), fault("duplicate"), fault("truncated"))
             .groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
                                  *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated"))))
    digests = _digests(_scripted(lettered, plans))
    found = turns.join(plans.drop("of"), "conv").join(digests, "conv")
    wanted = (rows if ids is None else ids).select(F.struct(F.col("conv_id").alias("id")).alias("conv")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return wanted.join(found, "conv", "left").select(
        F.col("conv.id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults to find, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a
    row, 1 empties its text, 2 takes its end marks away, 3 repeats it, 4 makes it the user's."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    return (rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy"))
