"""Repair of conversation structure: the cheapest edits to system? (user assistant)+ or nothing.

Damage is done by `damage`, faults are marked by `marked_turns`. Turns are in order of turn (null
first), role, text. A turn's first fault counts: blank, duplicate (its role and text stood earlier
in the conversation), truncated (its last character that is no blank ends no sentence).

Edits of a turn: Keep costs 0, Rerole to user or assistant 1, Delete 2; blank and duplicate turns
must go; a truncated turn that stays costs 5 more. A turn without text can be Inserted anywhere for
5. What is left spells `(s?(ua)+)?` in role initials. Of equally cheap edits the audit, their
initials in order, that is least in ASCII wins.

`cheapest_edits` is a shortest path over (turns passed, role awaited) whose lengths are single
integers: high digits are the cost, low digits a fixed number of places for the letters from here
on, the next one first and zeros behind the last. The smaller integer is the better path, in cost
and then in letters, as no letter is zero. The next letter and the state tell where an edit leads,
so two paths from one node that differ at all differ at a letter both have. Long conversations can
therefore be done in windows: only the cost of what follows a window, not its letters, can matter
in it, and numbers stay short.

Conversations of any length and number: turns are sorted over the whole input by range, equal
turns too, and tasks pack neighbours into chunks of bounded size with a byte for each turn. The
bytes of a conversation (as many as its audit has at least) meet in a task, not its texts. SHA-256
takes a text from start to end, so a conversation's chunks pass through one task in order, one
chunk at a time.

Null conv_id is a conversation of its own; a null turn comes first; a null role or text is a
blank. Equal rows are turns one after another, all but one of them duplicates. Empty texts are
blank turns. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.staging import stage

BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
CHUNK_TURNS = 1_024
CHUNK_BYTES = 1 << 17
BATCH_CHUNKS = 256
WINDOW = 64  # turns whose letters are decided at a time
KNOWN = 50_000  # outcomes of short conversations that a task remembers
# Costs of edits, letters of the audit in ASCII order.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
LETTERS = "\0DIKR"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
INITIALS = "sua"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what was emitted last

_DIGIT = 3  # bits of a letter
_PLACES = _DIGIT * 3 * (WINDOW + 1)  # a turn has one letter and at most two before it
_LOW = (1 << _PLACES) - 1
_NEVER = 1 << (_PLACES + 62)
_SPOKEN = [USER, USER, ASSISTANT, USER]  # what an insertion or a new role emits in each state
_KEPT = [{0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER}]  # by initial


def _edit(rest: int, letter: int, cost: int) -> int:
    """The integer of a path that makes an edit and then goes on as `rest`."""
    high = ((rest >> _PLACES) + cost) << _PLACES
    return high | (letter << (_PLACES - _DIGIT)) | ((rest & _LOW) >> _DIGIT)


def _inserted(values: list[int]) -> list[int]:
    for _ in range(2):
        values = [min(v, _edit(values[_SPOKEN[q]], 2, INSERT)) for q, v in enumerate(values)]
    return values


def _window(codes: bytes, values: list[int]) -> list[int]:
    """Least integers in front of the turns, from those behind them, for each state."""
    for code in reversed(codes):
        initial, fault = code & 3, code >> 2
        before = []
        for q in range(4):
            best = _edit(values[q], 1, DELETE)
            if fault not in (BLANK, DUPLICATE):
                more = CUT_OFF if fault == TRUNCATED else 0
                if initial in _KEPT[q]:
                    best = min(best, _edit(values[_KEPT[q][initial]], 3, KEEP + more))
                best = min(best, _edit(values[_SPOKEN[q]], 4, REROLE + more))
            before.append(best)
        values = _inserted(before)
    return values


def _spell(value: int) -> str:
    low, out = value & _LOW, []
    while low:
        out.append(LETTERS[low >> (_PLACES - _DIGIT)])
        low = (low << _DIGIT) & _LOW
    return "".join(out)


def walk(letters: str, codes: bytes, state: int) -> Iterator[tuple[str, int | None, int]]:
    """(letter, turn it uses, state behind it) of each edit."""
    at = 0
    for letter in letters:
        if letter == "K":
            state = _KEPT[state][codes[at] & 3]
        elif letter != "D":
            state = _SPOKEN[state]
        yield letter, (None if letter == "I" else at), state
        at += letter != "I"


def cheapest_edits(codes: bytes) -> tuple[int, list[tuple[str, int]]]:
    """Least cost, and the letters of each window of turns with the state in front of it.

    A byte of `codes` is initial + 4 * fault of a turn.
    """
    values = _inserted([0, _NEVER, _NEVER, 0])
    parts = []
    for low in range((len(codes) - 1) // WINDOW * WINDOW, -1, -WINDOW):
        values = _window(codes[low : low + WINDOW], values)
        parts.append([_spell(v) for v in values])
        values = [v >> _PLACES << _PLACES for v in values]
    state, out = NOTHING, []
    for k, spelled in enumerate(reversed(parts)):
        out.append((spelled[state], state))
        for _, _, state in walk(spelled[state], codes[k * WINDOW : (k + 1) * WINDOW], state):
            pass
    return values[NOTHING] >> _PLACES, out


# Turns


def damage(conversations: DataFrame) -> DataFrame:
    """The turns after damage by the checksum of `conv_id:turn`; nulls there are a blank."""
    blank = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.coalesce("text", blank)
    damaged = conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        fate.alias("_fate"),
    ).filter("_fate != 0")
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_fate") == 3, 2).otherwise(1)))
    return damaged.withColumn("_copy", copies).drop("_fate", "_copy")


def _same(frame: DataFrame, other: DataFrame, *keys: str) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & frame[key].eqNullSafe(other[f"_{key}"])
    return on


def marked_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, at, code (initial + 4 * fault); `turns` has no null role or text."""
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = turns.withColumn("key", key).withColumn("at", F.monotonically_increasing_id())
    placed = stage(placed, "damaged_turns")
    first = F.min(F.struct(F.col("turn").isNotNull(), "turn", "at"))["at"]
    repeated = placed.groupBy(F.col("conv_id").alias("_conv_id"), F.col("key").alias("_key")).agg(
        first.alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    repeated = stage(repeated.filter("_n > 1").drop("_n"), "repeated_turns")
    joined = placed.join(repeated, _same(placed, repeated, "conv_id", "key"), "left")

    ending = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(ending == "", BLANK)
        .when(F.col("_first").isNotNull() & (F.col("_first") != F.col("at")), DUPLICATE)
        .when(~F.right(ending, F.lit(1)).isin(*STOPS), TRUNCATED)
        .otherwise(0)
    )
    initial = F.substring("role", 1, 1)
    number = F.lit(len(INITIALS))
    for i, c in enumerate(INITIALS):
        number = F.when(initial == c, i).otherwise(number)
    return joined.select("conv_id", "turn", "role", "text", "at", (number + 4 * fault).alias("code"))


def turn_chunks(marked: DataFrame) -> DataFrame:
    """conv_id, part, seq, codes, roles, texts: neighbouring turns; (part, seq) is their order.

    Texts of turns that must go are left out (empty).
    """
    kind = marked.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text", "at"]
    names = ["conv_id", "seq", "codes", "roles", "texts"]
    types = pa.schema(
        [("seq", pa.int64()), ("codes", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, seq, size, own, codes, roles, texts = [], 0, 0, None, bytearray(), [], []

        def send(ids: pa.DataType) -> pa.RecordBatch:
            columns = zip(*ready)
            kinds = [ids, *(f.type for f in types)]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        ids = None
        for batch in batches:
            ids = batch.schema.field("conv_id").type
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "code")))
            for conv_id, role, text, code in rows:
                text = "" if code >> 2 in (BLANK, DUPLICATE) else text
                if codes and (conv_id != own or len(codes) >= CHUNK_TURNS or size + len(text) > CHUNK_BYTES):
                    ready.append((own, seq, bytes(codes), roles, texts))
                    seq, size, codes, roles, texts = seq + 1, 0, bytearray(), [], []
                    if len(ready) >= BATCH_CHUNKS:
                        yield send(ids)
                        ready.clear()
                own, size = conv_id, size + len(text)
                codes.append(code)
                roles.append(role)
                texts.append(text)
        if codes:
            ready.append((own, seq, bytes(codes), roles, texts))
        if ready:
            yield send(ids)

    schema = f"conv_id {kind}, seq bigint, codes binary, roles array<string>, texts array<string>"
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "at")
    chunks = dealt.mapInArrow(pack, schema).withColumn("part", F.spark_partition_id())
    return stage(chunks, "turn_chunks")


# Conversations


def _illegal(codes: bytes) -> int:
    spoken = [c & 3 for c in codes]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(spoken, spoken[1:]))


def _faults(codes: bytes) -> list[int]:
    return [sum(c >> 2 == fault for c in codes) for fault in (BLANK, DUPLICATE, TRUNCATED)]


def _pieces(letters: str, codes: bytes, lengths: list[int]) -> Iterator[tuple[str, int]]:
    """The letters that use the turns of each chunk (and insertions in front of them), its state."""
    bound, start, state, here = lengths[0], 0, NOTHING, NOTHING
    k, used = 0, 0
    for i, (_, turn, behind) in enumerate(walk(letters, codes, NOTHING)):
        if used == bound and k + 1 < len(lengths):
            yield letters[start:i], state
            k, start, state = k + 1, i, here
            bound += lengths[k]
        used += turn is not None
        here = behind
    yield letters[start:], state


def chunk_edits(chunks: DataFrame) -> DataFrame:
    """Per chunk its edits and state, and the counts and cost of its conversation."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "seq", "letters", "state", "blank", "duplicate", "truncated", "illegal", "cost"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own, rows, out, known = None, None, [], [], {}

        def edits(codes: bytes) -> tuple[int, str]:
            if codes in known:
                return known[codes]
            cost, windows = cheapest_edits(codes)
            found = cost, "".join(letters for letters, _ in windows)
            if len(codes) <= WINDOW and len(known) < KNOWN:
                known[codes] = found
            return found

        def finish() -> None:
            codes = b"".join(r["codes"] for r in rows)
            cost, letters = edits(codes)
            counts = [*_faults(codes), _illegal(codes), cost]
            for r, (letters, state) in zip(rows, _pieces(letters, codes, [len(r["codes"]) for r in rows])):
                out.append((r["conv_id"], r["part"], r["seq"], letters, state, *counts))

        def send() -> pa.RecordBatch:
            kinds = [ids, pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 6]
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return batch

        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if rows and row["conv_id"] != own:
                    finish()
                    rows = []
                    if len(out) >= BATCH_CHUNKS:
                        yield send()
                own = row["conv_id"]
                rows.append(row)
        if rows:
            finish()
            yield send()

    place = ["conv_id", "part", "seq"]
    dealt = chunks.select(*place, "codes").repartition("conv_id").sortWithinPartitions(*place)
    counts = ", ".join(f"{c} bigint" for c in names[4:])
    return dealt.mapInArrow(solve, f"conv_id {kind}, part int, seq bigint, letters string, {counts}")


def repaired_lines(chunk: dict, letters: str, state: int) -> Iterator[str]:
    """`role:text` of what the edits leave of a chunk."""
    for letter, turn, behind in walk(letters, chunk["codes"], state):
        spoken = {USER: "user", ASSISTANT: "assistant"}.get(behind, "")
        if letter == "K":
            yield f"{chunk['roles'][turn]}:{chunk['texts'][turn]}"
        elif letter == "R":
            yield f"{spoken}:{chunk['texts'][turn]}"
        elif letter == "I":
            yield f"{spoken}:"


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def repaired(chunks: DataFrame, edits: DataFrame) -> DataFrame:
    """Per conversation with turns: counts, cost, audit and the hash of the repaired turns."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own, head, audit, digest, lines, out = None, None, None, [], None, 0, []

        def send() -> pa.RecordBatch:
            kinds = [ids, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return batch

        def finish() -> None:
            out.append((own, *(head[c] for c in COUNTS), "".join(audit), digest.hexdigest()))

        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if row["letters"] is not None:  # the edits of a chunk come before it
                    if head is not None and row["conv_id"] != own:
                        finish()
                        head = None
                        if len(out) >= BATCH_CHUNKS:
                            yield send()
                    if head is None:
                        own, audit, digest, lines = row["conv_id"], [], hashlib.sha256(), 0
                    head = row
                    audit.append(row["letters"])
                    continue
                for line in repaired_lines(row, head["letters"], head["state"]):
                    digest.update(("\n" + line if lines else line).encode())
                    lines += 1
        if head is not None:
            finish()
        if out:
            yield send()

    both = edits.withColumn("kind", F.lit(0)).unionByName(
        chunks.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "kind")
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return dealt.mapInArrow(stream, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """Counts of faults, cost, audit and hash of every conversation of `turns`."""
    chunks = turn_chunks(marked_turns(turns))
    return repaired(chunks, chunk_edits(chunks))


def turn_gaps(turns: DataFrame) -> DataFrame:
    """(_conv_id, gaps): turn numbers missing between a conversation's first and last."""
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return turns.groupBy(F.col("conv_id").alias("_conv_id")).agg(F.coalesce(missing, F.lit(0)).alias("gaps"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Damage, then repair: a row for each conv_id of the table."""
    turns = damage(conversations)
    ids = conversations.select("conv_id").distinct()
    gaps = turn_gaps(turns)
    fixed = repair(turns).withColumnRenamed("conv_id", "_conv_id")
    found = ids.join(gaps, _same(ids, gaps, "conv_id"), "left").drop("_conv_id")
    found = found.join(fixed, _same(found, fixed, "conv_id"), "left").drop("_conv_id")
    none = hashlib.sha256().hexdigest()
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *COUNTS)]
    return found.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )


def _repair_sql() -> str:
    """The same in SQL: folds over the lists of a conversation's turns and edits."""
    never = 1_000_000_000

    def edit(state: int, letter: str, cost: str) -> str:
        return f"{{'c': v[{state + 1}].c + {cost}, 'a': '{letter}' || v[{state + 1}].a}}"

    def turn(q: int) -> str:
        stays = f"CASE WHEN t.fault IN (1, 2) THEN {never} WHEN t.fault = 3 THEN {CUT_OFF} ELSE 0 END"
        kept = [
            f"CASE WHEN t.initial = '{INITIALS[i]}' THEN {edit(to, 'K', f'{stays} + {KEEP}')} ELSE {edit(q, 'K', str(never))} END"
            for i, to in _KEPT[q].items()
        ]
        return f"least({edit(q, 'D', str(DELETE))}, {', '.join(kept)}, {edit(_SPOKEN[q], 'R', f'{stays} + {REROLE}')})"

    def let(value: str, body: str) -> str:
        return f"list_transform([{value}], lambda v: {body})[1]"

    insert = ", ".join(f"least(v[{q + 1}], {edit(_SPOKEN[q], 'I', str(INSERT))})" for q in range(4))
    inserted = lambda value: let(let(value, f"[{insert}]"), f"[{insert}]")
    turns = f"[{', '.join(turn(q) for q in range(4))}]"
    start = f"[{', '.join(f"{{'c': {0 if q in (NOTHING, ASSISTANT) else never}::BIGINT, 'a': ''}}" for q in range(4))}]"
    behind = (
        "CASE WHEN e = 'D' THEN p.state WHEN e = 'K' AND turns[p.used + 1].initial = 's' THEN 1"
        " WHEN p.state = 2 THEN 3 ELSE 2 END"
    )
    spoken = "CASE WHEN p.state = 2 THEN 'assistant:' ELSE 'user:' END"
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
summed AS (
  SELECT *, xor(4294967295, list_reduce(
    list_transform(string_split(key, ''), lambda b: unicode(b)::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, b)),
    4294967295::BIGINT)) % 20 AS fate
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE fate WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM summed WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ending
  FROM damaged),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS again FROM placed),
marked AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
         CASE WHEN ending = '' THEN 1 WHEN again > 1 THEN 2
              WHEN right(ending, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM counted),
whole AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'role': role, 'text': text, 'initial': initial, 'fault': fault}} ORDER BY place) AS turns
  FROM marked GROUP BY conv_id),
solved AS (
  SELECT *, list_reduce(list_reverse(turns), lambda v, t: {inserted(turns)}, {inserted(start)})[1] AS best FROM whole),
written AS (
  SELECT *, list_reduce(string_split(best.a, ''), lambda p, e: {{
    'state': {behind}, 'used': p.used + CASE WHEN e = 'I' THEN 0 ELSE 1 END,
    'lines': CASE e WHEN 'D' THEN p.lines
      WHEN 'K' THEN list_append(p.lines, turns[p.used + 1].role || ':' || turns[p.used + 1].text)
      WHEN 'R' THEN list_append(p.lines, {spoken} || turns[p.used + 1].text)
      ELSE list_append(p.lines, {spoken}) END}},
    {{'state': 0, 'used': 0, 'lines': []::VARCHAR[]}}).lines AS lines
  FROM solved)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i
LEFT JOIN written AS w ON i.conv_id IS NOT DISTINCT FROM w.conv_id
"""


REPAIR_SQL = _repair_sql()
