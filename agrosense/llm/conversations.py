r"""Conversation structure repair by iterative-deepening A*.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``: nothing, or an
optional system turn and then pairs of user and assistant. Its rows are repaired by edits:
keep (0), give another role (2), delete (3; the only edit of a blank or duplicate row), insert
an empty user or assistant turn (2); a truncated row that stays adds 1. The audit is the
cheapest list of edits, as initials ``D I K R``; of equally cheap lists the ASCII-least.

The search is depth-first in ASCII order under a cost bound that grows to the least cost that
exceeded it. A table of failed states (row, role state -> budget that failed) stops repeated
work, and the bound of the rest is the sum of what its rows must cost alone (a deletion, a
truncation, a role that fits nowhere) and of disjoint neighbours that cannot both stay as they
are. The first accepting path is the answer.

Conversations of any length: rows are ordered by one range-partitioned sort and get a one-byte
code. ``SEGMENT`` rows are searched at a time, in pieces of ``PIECE`` rows. What a path costs
from each role state to each other is a 4 x 4 matrix per segment; matrices, multiplied from the
end, give the cost that follows each segment; then all segments are searched independently,
from every state they can be entered in, and the chain of states picks one path of each. A
conversation of one segment needs no matrix. Only these matrices (128 bytes for 4,096 rows) and
the audit itself, one cell of the result, come together per conversation. SHA-256 has no
parallel form, so the repaired lines of one conversation pass one task, as a stream.

Defined cases: nulls are one space each, also in the damage key; a null ``conv_id`` is a
conversation of its own; rows are ordered by turn (nulls first), then role, the first 64
characters of the text and its SHA-256; equal rows are duplicates of their first; a role whose
first character is not s, u or a (an empty one too) cannot be kept; very long texts are
hashed as they stream by; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.llm.common import ship, stored

ship(__name__)

SEGMENT_BITS = 12                     # a segment: rows whose ids differ in the last 12 bits only
PIECE = 8                             # rows of one search
ROWS_PER_TASK = 20_000                # rows searched by one task
INFINITE = 1 << 60

# Fixed values of the contract.
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
OK, BLANK, DUPLICATE, TRUNCATED = range(4)            # faults
SYSTEM, USER, ASSISTANT, OTHER = range(4)             # role classes by initial
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)           # role states
LEGAL_NEXT = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))

STEP = {(EMPTY, SYSTEM): AFTER_S, (EMPTY, USER): AFTER_U, (AFTER_S, USER): AFTER_U,
        (AFTER_U, ASSISTANT): AFTER_A, (AFTER_A, USER): AFTER_U}
# the user or assistant turn that can follow a state, and the state after it
WANTED = {EMPTY: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A),
          AFTER_A: ("user", AFTER_U)}
AT_END = [0, 2 * INSERT_COST, INSERT_COST, 0]         # what each state costs after the last row
END_EDITS = ["", "II", "I", ""]


# ---- the search ------------------------------------------------------------------------------

def _codes(text: str) -> list[tuple[int, int]]:
    return [divmod(ord(ch) - 65, 4) for ch in text]


def rest_bounds(rows, exits) -> list[list[int]]:
    """For each row and role state the least that this and all later rows can cost.

    Every row pays what it must alone. Two rows with only rows to be deleted between them, that
    cannot follow each other as they are, pay 2 more: one of them goes or gets a role, or a turn
    comes between. So do the state and the first row, and the last row and the exit. The sum
    over disjoint pairs is a lower bound; the best packing of pairs is taken."""
    n, after = len(rows), min(exits)
    must = [f in (BLANK, DUPLICATE) for _, f in rows]
    own = []
    for cls, fault in rows:
        cut = TRUNCATED_COST if fault == TRUNCATED else 0
        own.append(DELETE_COST if fault in (BLANK, DUPLICATE)
                   else min(DELETE_COST, REROLE_COST + cut) if cls == OTHER else cut)
    least = [after] * (n + 1)                         # whatever the state
    out = [list(exits)] * (n + 1)
    nxt, deleted = n, 0                               # the next row that may stay; deletions before it
    for i in range(n - 1, -1, -1):
        if must[i]:
            deleted += DELETE_COST
            least[i] = least[i + 1] + DELETE_COST
        else:
            cls, best = rows[i][0], least[i + 1] + own[i]
            if cls != OTHER:
                if nxt == n:
                    kept = exits[(AFTER_S, AFTER_U, AFTER_A)[cls]]
                    best = max(best, deleted + own[i] + min(kept, 2 + after))
                elif rows[nxt][0] != OTHER and (cls, rows[nxt][0]) not in LEGAL_NEXT:
                    best = max(best, least[nxt + 1] + own[i] + own[nxt] + deleted + 2)
            least[i] = best
            nxt, deleted = i, 0
        if nxt == n:
            out[i] = [deleted + min(exits[q], INSERT_COST + after) for q in range(4)]
        else:
            first = deleted + own[nxt] + 2 + least[nxt + 1]
            cls = rows[nxt][0]
            out[i] = [max(least[i], first) if cls != OTHER and (q, cls) not in STEP else least[i] for q in range(4)]
    return out


def search(rows, state: int, exits) -> tuple[int, str, int] | None:
    """Cheapest path over ``rows`` from ``state``: its cost with the exit's, its edits, and the
    state it ends in. ``exits`` is what follows each end state; None if none can be reached."""
    n = len(rows)
    rest = rest_bounds(rows, exits)
    bound, most = rest[0][state], DELETE_COST * n + 2 * INSERT_COST + max(e for e in exits if e < INFINITE)
    while bound <= most:
        failed: dict = {}
        over = INFINITE

        def visit(i, q, left):
            nonlocal over
            if rest[i][q] > left:
                over = min(over, rest[i][q] - left)
                return None
            if i == n:
                return "", q
            if failed.get((i, q), -1) >= left:
                return None
            for edit, cost, on, to_q in EDITS[rows[i]][q]:
                if cost <= left:
                    found = visit(i + on, to_q, left - cost)
                    if found is not None:
                        return edit + found[0], found[1]
                else:
                    over = min(over, cost - left)
            failed[i, q] = left
            return None

        found = visit(0, state, bound)
        if found is not None:
            return bound, found[0], found[1]
        bound += over
    return None


def _edits(cls, fault, q):
    """Edits of a row in ASCII order: initial, cost, rows passed, next state."""
    yield "D", DELETE_COST, 1, q
    yield "I", INSERT_COST, 0, WANTED[q][1]
    if fault not in (BLANK, DUPLICATE):
        cut = TRUNCATED_COST if fault == TRUNCATED else 0
        if (q, cls) in STEP:
            yield "K", KEEP_COST + cut, 1, STEP[q, cls]
        yield "R", REROLE_COST + cut, 1, WANTED[q][1]


EDITS = {(cls, fault): [tuple(_edits(cls, fault, q)) for q in range(4)] for cls in range(4) for fault in range(4)}


def _pieces(rows):
    return [rows[k:k + PIECE] for k in range(0, len(rows), PIECE)]


def _cost_matrix(rows):
    """What the cheapest path costs from each state to each (``INFINITE``: none)."""
    system = any(c == SYSTEM and f in (OK, TRUNCATED) for c, f in rows)
    out = [[INFINITE] * 4 for _ in range(4)]
    for a in range(4):
        for b in range(4):
            if (b == EMPTY and a != EMPTY) or (b == AFTER_S and a != AFTER_S and not (a == EMPTY and system)):
                continue
            found = search(rows, a, [0 if k == b else INFINITE for k in range(4)])
            if found is not None:
                out[a][b] = found[0]
    return out


def _times(left, right):
    return [[min(INFINITE, min(left[a][k] + right[k][b] for k in range(4))) for b in range(4)]
            for a in range(4)]


def _before(matrix, exits):
    """Cost of the rest in each state before a stretch, from that after it."""
    return [min(INFINITE, min(matrix[a][k] + exits[k] for k in range(4))) for a in range(4)]


def segment_matrix(codes: str):
    total = None
    for piece in _pieces(_codes(codes)):
        m = _cost_matrix(piece)
        total = m if total is None else _times(total, m)
    return total


def segment_paths(codes: str, entries, exits, last: bool):
    """For each state in ``entries`` the cost, edits and end state of the segment's best path."""
    pieces = _pieces(_codes(codes))
    after = [exits]
    for piece in pieces[:0:-1]:
        after.append(_before(_cost_matrix(piece), after[-1]))
    after.reverse()
    out = {}
    for entry in entries:
        state, edits, cost = entry, [], None
        for piece, then in zip(pieces, after):
            found = search(piece, state, then)
            cost = found[0] if cost is None else cost
            edits.append(found[1])
            state = found[2]
        out[entry] = (cost, "".join(edits) + (END_EDITS[state] if last else ""), state)
    return out


# ---- the job ---------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """``c`` (a struct of conv_id), ``turn, role, text`` of the rows after damage."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.struct("conv_id").alias("c"), "turn", blank("role").alias("role"), blank("text").alias("text"),
        kind.alias("kind"))
    return (rows.where("kind <> 0")
            .withColumn("role", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("text", F.when(F.col("kind") == 1, F.lit("")).when(
                F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .select("c", "turn", "role", "text", F.explode(F.array_repeat(
                F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with an ``id`` that grows in the order of conversation and turn."""
    keys = ["c", "turn", "role", "head", "digest"]
    return stored(
        rows.withColumns({"head": F.left("text", F.lit(64)), "digest": F.unhex(F.sha2("text", 256))})
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("id", F.monotonically_increasing_id()).drop("head"), "repair-rows")


def _segments(rows: DataFrame) -> DataFrame:
    """``c, seg, codes``: one letter for each row's role class and first fault."""
    first = rows.groupBy("c", "role", "digest").agg(F.min("id").alias("id")).select(
        "id", F.lit(True).alias("first"))
    seen = r"[^\x20\x09-\x0D]"
    facts = rows.select("c", "id", "role",
                        (~F.col("text").rlike(seen)).alias("blank"),
                        F.regexp_extract("text", rf"({seen})[\x20\x09-\x0D]*\z", 1).alias("end"))
    start = F.left("role", F.lit(1))
    cls = (F.when(start == "s", SYSTEM).when(start == "u", USER).when(start == "a", ASSISTANT)
           .otherwise(OTHER))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.col("end").isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    coded = facts.join(first, "id", "left").select("c", "id", F.char(65 + 4 * cls + fault).alias("code"))
    return stored(coded.groupBy("c", F.shiftright("id", SEGMENT_BITS).alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("id", "code"))).alias("rows")).select(
        "c", "seg", F.array_join("rows.code", "").alias("codes")), "repair-segments")


def _per_row(fn, columns):
    """A ``mapInArrow`` function that gives each row as a tuple to ``fn`` and yields what it
    returns, next to the row's first column."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            given = [b.column(k).to_pylist() for k in range(1, b.num_columns)]
            out, at = [[] for _ in columns], []
            for k, row in enumerate(zip(*given)):
                for made in fn(*row):
                    at.append(k)
                    for col, v in zip(out, made):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64()))] + [pa.array(v, t) for v, (_, t) in zip(out, columns)],
                names=[b.schema.names[0]] + [n for n, _ in columns])
    return run


def _matrix_rows(seg, codes):
    yield seg, [v for line in segment_matrix(codes) for v in line]


def _exit_rows(parts):
    exits = AT_END
    for k in range(len(parts) - 1, -1, -1):
        yield parts[k]["seg"], exits, k == 0, k == len(parts) - 1
        m = parts[k]["m"]
        exits = _before([m[4 * a:4 * a + 4] for a in range(4)], exits)


def _path_rows(seg, codes, exits, first, last):
    alone = exits is None
    found = segment_paths(codes, [EMPTY] if alone or first else range(4), AT_END if alone else exits,
                          alone or last)
    rows = _codes(codes)
    illegal = sum((a[0], b[0]) not in LEGAL_NEXT for a, b in zip(rows, rows[1:]))
    counts = [sum(f == k for _, f in rows) for k in (BLANK, DUPLICATE, TRUNCATED)]
    paths = [found.get(q, (None, None, None)) for q in range(4)]
    yield (seg, [p[0] for p in paths], [p[1] for p in paths], [p[2] for p in paths],
           rows[0][0], rows[-1][0], illegal, *counts)


def _chain_rows(parts):
    state, entries, illegal = EMPTY, [], 0
    for k, p in enumerate(parts):
        entries.append(state)
        state = p["ends"][state]
        illegal += p["illegal"] + (k > 0 and (parts[k - 1]["last_cls"], p["first_cls"]) not in LEGAL_NEXT)
    yield ([p["seg"] for p in parts], entries, *(sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated")),
           illegal, parts[0]["costs"][EMPTY])


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Codes are few bytes but much work: spread by rows, which Spark would put by bytes into
    one task."""
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)), "c", "seg")


def _gathered(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy("c").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("parts"))


def _digests(kind: str):
    """Stream of ``c, id, path, role, text`` in order (a segment's path before its rows) to the
    SHA-256 of each conversation's repaired lines."""
    def run(batches):
        import pyarrow as pa

        now, sha, begun, edits, at, state = None, None, False, "", 0, EMPTY
        done_c, done_sha = [], []

        def line(role, text):
            nonlocal begun
            if begun:
                sha.update(b"\n")
            begun = True
            sha.update(f"{role}:".encode())
            sha.update(text.encode())

        def inserts():
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                role, state = WANTED[state]
                line(role, "")
                at += 1

        def close():
            if sha is not None:
                inserts()
                done_c.append(now)
                done_sha.append(sha.hexdigest())

        c_type = None
        for b in batches:
            c_type = b.schema.field(0).type
            for c, path, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(),
                                           b.column(3).to_pylist(), b.column(4).to_pylist()):
                if sha is None or c != now:
                    close()
                    now, sha, begun, edits, at, state = c, hashlib.sha256(), False, "", 0, EMPTY
                if path is not None:
                    inserts()
                    edits, at = path, 0
                    continue
                inserts()
                edit = edits[at]
                at += 1
                if edit == "K":
                    line(role, text)
                    state = STEP[state, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]]
                elif edit == "R":
                    new, state = WANTED[state]
                    line(new, text)
            if done_c:
                yield pa.RecordBatch.from_arrays([pa.array(done_c, c_type), pa.array(done_sha)], names=["c", "sha"])
                done_c, done_sha = [], []
        close()
        if done_c:
            yield pa.RecordBatch.from_arrays([pa.array(done_c, c_type), pa.array(done_sha)], names=["c", "sha"])
    return run


def repair(conversations: DataFrame):
    """``(rows, pieces, summary)``: the damaged rows in order (``c, id, turn, role, text``), the
    edits of each segment (``c, seg, path``) and one row of counts per conversation."""
    import pyarrow as pa

    key = f"c {conversations.select(F.struct('conv_id').alias('c')).schema['c'].dataType.simpleString()}"
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    rows = _ordered(damage(conversations))
    segments = _segments(rows)

    many = segments.join(segments.groupBy("c").count().where("count > 1").select("c"), "c", "left_semi")
    work = segments.agg(F.sum(F.length("codes"))).first()[0] or 0
    matrices = stored(_spread(many.select("c", "seg", "codes"), work).mapInArrow(
        _per_row(_matrix_rows, [("seg", pa.int64()), ("m", longs)]), f"{key}, seg long, m array<long>"),
        "repair-matrices")
    exits = _gathered(matrices, "seg", "m").mapInArrow(
        _per_row(_exit_rows, [("seg", pa.int64()), ("exits", longs), ("first", pa.bool_()), ("last", pa.bool_())]),
        f"{key}, seg long, exits array<long>, first boolean, last boolean")
    solved = stored(_spread(segments.join(exits, ["c", "seg"], "left").select(
        "c", "seg", "codes", "exits", "first", "last"), work).mapInArrow(
        _per_row(_path_rows, [("seg", pa.int64()), ("costs", longs), ("paths", pa.list_(pa.string())), ("ends", ints),
                              *((n, pa.int64()) for n in ("first_cls", "last_cls", "illegal", "blank", "duplicate",
                                                          "truncated"))]),
        f"{key}, seg long, costs array<long>, paths array<string>, ends array<int>, first_cls long, "
        "last_cls long, illegal long, blank long, duplicate long, truncated long"), "repair-paths")
    chained = stored(_gathered(solved, "seg", "costs", "ends", "first_cls", "last_cls", "illegal", "blank",
                               "duplicate", "truncated").mapInArrow(
        _per_row(_chain_rows, [("segs", longs), ("entries", ints),
                               *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost"))]),
        f"{key}, segs array<long>, entries array<int>, blank long, duplicate long, truncated long, "
        "illegal long, cost long"), "repair-chains")
    entered = chained.select("c", F.explode(F.arrays_zip("segs", "entries")).alias("e")).select(
        "c", F.col("e.segs").alias("seg"), F.col("e.entries").alias("entry"))
    pieces = stored(solved.select("c", "seg", "paths").join(entered, ["c", "seg"]).select(
        "c", "seg", F.get("paths", F.col("entry")).alias("path")), "repair-pieces")
    return rows, pieces, chained.drop("segs", "entries")


def repaired_digests(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """``c, sha`` of the repaired ``role:text`` lines of each conversation."""
    kind = rows.schema["c"].dataType.simpleString()
    stream = pieces.select("c", F.shiftleft("seg", SEGMENT_BITS).alias("id"), "path", F.lit(None).cast("string").alias("role"),
                           F.lit(None).cast("string").alias("text")).unionAll(
        rows.select("c", "id", F.lit(None).cast("string"), "role", "text"))
    return (stream.repartition("c").sortWithinPartitions("c", "id", F.col("path").asc_nulls_last())
            .mapInArrow(_digests(kind), f"c {kind}, sha string"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of the table: ``gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``."""
    rows, pieces, counts = repair(conversations)
    turns = rows.where("turn is not null").groupBy("c", "turn").count().groupBy("c").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    audits = _gathered(pieces, "seg", "path").select("c", F.array_join("parts.path", "").alias("audit"))
    out = conversations.select(F.struct("conv_id").alias("c")).distinct()
    for part in (turns, counts, audits, repaired_digests(rows, pieces)):
        out = out.join(part, "c", "left")
    zero = [F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n)
            for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("c.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
