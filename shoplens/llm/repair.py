"""Conversation structure repair over a suffix-shared automaton; least cost, audited.

A row's symbol is its role's initial (or "other") with its first fault: blank, duplicate, truncated or none.  A
conversation's signature is the string of its symbols.  Its rows are kept, re-roled or deleted and empty turns inserted so
that the roles follow the grammar ``(s?(ua)+)?``, whose four states are: nothing yet, after a system turn, after a user
turn, after an assistant turn.

What is best to do from some row on depends on the signature's rest from there and the grammar state alone.  The rests of
all conversations form an acyclic automaton, shared from the end: a node for each distinct suffix, reached from its
symbol and the node of the suffix behind it.  Conversations are sorted by their reversed signatures, dealt by ranges, and
each task walks its range with the nodes of the current suffixes on a stack: a suffix shared by many conversations is a
node that is made once, with four costs-to-go and four audit suffixes, which share their own ends.  A signature held by a
third of all conversations is cut over many tasks like any other range.

An edit in a state leads to one state only, so edits of equal cost differ in their initials, and taking the least
initial gives the ASCII-least audit.

Rows pass through two sorted streams by conversation: one of hashes and symbols, which gives signatures and counts, and
one of texts, beside each conversation's audit, which gives the repaired rows.  A task holds a conversation's signature
and audit, a byte for each row, but never its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code, staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: where a user or assistant turn leads that the state allows: the only one an insert or re-role can give
TURN = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: where a kept row leads, by its role's initial
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
GONE = "D"  # the symbol of rows that must be deleted
FAR = 1 << 60

SPACE = r"\x20\x09-\x0D"
SIGNED = "conv string, no_conv boolean, back string, gaps long, blank long, duplicate long, truncated long, illegal long"  # back: the signature, reversed
REPAIRED = "conv string, no_conv boolean, position long, role string, text string, edit string"


# ---- damage -------------------------------------------------------------------------------------------------------

def damage(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` (conv_id, turn, role, text) with faults planted by ``crc32("conv_id:turn") % 20``: 0 drops the
    row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 sets its role to user.  A null is one space,
    also in the checksum; conv_id and turn stay null.  Dropped rows stay as rows whose ``dropped`` is true, so that their
    conversations are known."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("__copy")).drop("__copy")


# ---- signatures ---------------------------------------------------------------------------------------------------

def _text_faults(text: Column) -> tuple[Column, Column]:
    blank = ~text.rlike(f"[^{SPACE}]")
    return blank, ~blank & ~text.rlike(rf"[.!?][{SPACE}]*\z")


def _ordered(rows: DataFrame) -> DataFrame:
    """Columns that sort a conversation's rows: by turn, nulls first, then role and the text's hashes."""
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
                       F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("has_turn"), "role", F.md5("text").alias("h"), "text", "dropped")


def _symbols(rows: DataFrame) -> DataFrame:
    """The rows without texts, with their faults; ``repeated`` is true where the same role and text stand at an earlier turn
    (of rows alike in one turn, all but one are told by their neighbour in the order)."""
    blank, cut = _text_faults(F.col("text"))
    light = rows.select("conv", "no_conv", "turn", "has_turn", "role", "h", "dropped", blank.alias("blank"), cut.alias("cut"))
    same = ["conv", "no_conv", "role", "h"]
    firsts = light.filter("NOT dropped").groupBy(*same).agg(F.min(F.struct("has_turn", "turn")).alias("first"), F.max(F.struct("has_turn", "turn")).alias("last"))
    firsts = firsts.filter("first <> last").select(*(F.col(c).alias(f"f_{c}") for c in same), "first")  # those at several turns
    on = F.lit(True)
    for c in same:
        on = on & (F.col(c) == F.col(f"f_{c}"))
    later = F.coalesce(F.struct("has_turn", "turn") > F.col("first"), F.lit(False))
    return light.join(firsts, on, "left").withColumn("repeated", later).drop("first", *(f"f_{c}" for c in same))


def sign(rows: DataFrame) -> DataFrame:
    """``SIGNED`` of damaged rows: a row for each conversation, also where all its rows were dropped."""
    names = [c.split()[0] for c in SIGNED.split(", ")]

    def closed(key: tuple, s: dict) -> tuple:
        gaps = s["max"] - s["min"] + 1 - s["turns"] if s["turns"] else 0
        return (*key, "".join(reversed(s["symbols"])), gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, s = None, None
        for batch in batches:
            out = []
            for conv, no_conv, turn, has_turn, role, h, dropped, blank, cut, repeated in batch.itertuples(index=False, name=None):
                if s is None or now != (conv, no_conv):
                    if s is not None:
                        out.append(closed(now, s))
                    now = (conv, no_conv)
                    s = dict(symbols=[], min=None, max=None, turns=0, blank=0, duplicate=0, truncated=0, illegal=0, last=None, initial=None)
                if dropped:
                    continue
                if has_turn and (s["max"] is None or turn != s["max"]):
                    s["turns"] += 1
                    s["min"], s["max"] = turn if s["min"] is None else s["min"], turn
                initial = role[:1]
                if s["initial"] is not None and s["initial"] + initial not in LEGAL:
                    s["illegal"] += 1
                s["initial"] = initial
                alike = (has_turn, turn, role, h)
                fault = "blank" if blank else "duplicate" if repeated or alike == s["last"] else "truncated" if cut else None
                s["last"] = alike
                if fault:
                    s[fault] += 1
                symbol = initial if initial in ("s", "u", "a") else "x"
                s["symbols"].append(GONE if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
            if out:
                yield pd.DataFrame(out, columns=names)
        if s is not None:
            yield pd.DataFrame([closed(now, s)], columns=names)

    flagged = _symbols(_ordered(rows)).select("conv", "no_conv", "turn", "has_turn", "role", "h", "dropped", "blank", "cut", "repeated")
    return flagged.repartition("conv", "no_conv").sortWithinPartitions("conv", "no_conv", "dropped", "has_turn", "turn", "role", "h").mapInPandas(run, SIGNED)


# ---- the automaton ------------------------------------------------------------------------------------------------

class Node:
    """A suffix: for each grammar state the least cost from there to the end, and the audit as its first edit and the rest,
    which belongs to a node behind it."""

    __slots__ = ("cost", "audit")

    def __init__(self, symbol: str | None = None, behind: Node | None = None):
        base = []
        for state in range(4):
            if behind is None:
                base.append((0 if state in (START, ASSISTANT) else FAR, "", None))
                continue
            options = [(DELETE + behind.cost[state], "D", behind.audit[state])]
            if symbol != GONE:
                more = TRUNCATED if symbol.isupper() else 0
                to = KEPT.get((state, symbol.lower()))
                if to is not None:
                    options.append((more + behind.cost[to], "K", behind.audit[to]))
                to = TURN[state][0]
                options.append((REROLE + more + behind.cost[to], "R", behind.audit[to]))
            base.append(min(options, key=lambda o: o[:2]))
        self.cost, self.audit = [0] * 4, [None] * 4
        # an insert leads to another state of the same node; two of them in a row come back to it at a cost
        for state in (USER, ASSISTANT):
            other = TURN[state][0]
            self._take(state, base[state], base[other][0], lambda other=other: self._rest(base[other]))
        for state in (START, SYSTEM):
            self._take(state, base[state], self.cost[USER], lambda: self.audit[USER])

    @staticmethod
    def _rest(edit: tuple):
        return (edit[1], edit[2]) if edit[1] else None

    def _take(self, state: int, edit: tuple, after_insert: int, rest) -> None:
        cost = INSERT + after_insert
        if cost < edit[0] or cost == edit[0] and "I" < (edit[1] or "\0"):
            self.cost[state], self.audit[state] = cost, ("I", rest())
        else:
            self.cost[state], self.audit[state] = edit[0], self._rest(edit)


def spelled(audit) -> str:
    out = []
    while audit is not None:
        out.append(audit[0])
        audit = audit[1]
    return "".join(out)


class Automaton:
    """The nodes of the suffixes of sorted reversed signatures; ``made`` counts them."""

    def __init__(self):
        self.stack, self.back, self.made, self.best = [Node()], "", 1, None

    def repair(self, back: str) -> tuple[int, str]:
        """Cost and audit of a signature, given reversed."""
        if back != self.back or self.best is None:
            shared = 0
            for x, y in zip(back, self.back):
                if x != y:
                    break
                shared += 1
            del self.stack[shared + 1:]
            for symbol in back[shared:]:
                self.stack.append(Node(symbol, self.stack[-1]))
                self.made += 1
            top = self.stack[-1]
            self.back, self.best = back, (top.cost[START], spelled(top.audit[START]))
        return self.best


def audits(signed: DataFrame) -> DataFrame:
    """``signed`` with cost and audit."""
    names = [c for c in signed.columns if c != "back"]

    def run(batches):
        automaton = Automaton()
        for batch in batches:
            best = [automaton.repair(back) for back in batch.back]
            out = batch[names].copy()
            out["cost"], out["audit"] = [b[0] for b in best], [b[1] for b in best]
            yield out

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema.fields if f.name in names)
    dealt = signed.withColumn("spread", F.xxhash64("conv"))
    dealt = dealt.repartitionByRange("back", "spread").sortWithinPartitions("back", "spread").drop("spread")
    return dealt.mapInPandas(run, f"{kinds}, cost long, audit string")


# ---- the repaired rows --------------------------------------------------------------------------------------------

def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a conversation, its audit first: the repaired rows, in order."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]
    key, audit, at, state, position, out = None, "", 0, START, 0, []

    def turn(role: str, text: str, edit: str) -> None:
        nonlocal position
        out.append((*key, position, role, text, edit))
        position += 1

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, role = TURN[state]
            at += 1
            turn(role, "", "I")

    for batch in batches:
        for conv, no_conv, is_row, role, text in zip(batch.conv, batch.no_conv, batch.is_row, batch.role, batch.text):
            if not is_row:
                inserts()  # at the end of the conversation before
                key, audit, at, state, position = (conv, no_conv), text, 0, START, 0
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = KEPT[state, role[:1]]
                turn(role, text, edit)
            elif edit == "R":
                state, role = TURN[state]
                turn(role, text, edit)
        if out:
            yield pd.DataFrame(out, columns=names)
            out.clear()
    inserts()
    if out:
        yield pd.DataFrame(out, columns=names)


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``REPAIRED`` of damaged rows; each conversation's rows are in order, in one partition."""
    texts = _ordered(rows).filter("NOT dropped").select("conv", "no_conv", F.lit(True).alias("is_row"), "has_turn", "turn", "role", "h", "text")
    heads = audited.select("conv", "no_conv", F.lit(False).alias("is_row"), F.lit(False).alias("has_turn"), F.lit(0).cast("long").alias("turn"),
                           F.lit("").alias("role"), F.lit("").alias("h"), F.col("audit").alias("text"))
    both = heads.unionByName(texts).repartition("conv", "no_conv").sortWithinPartitions("conv", "no_conv", "is_row", "has_turn", "turn", "role", "h")
    return both.select("conv", "no_conv", "is_row", "role", "text").mapInPandas(_apply, REPAIRED)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, digest, columns = None, None, ["d_conv", "d_no_conv", "sha"]
    for batch in batches:
        out = []
        for conv, no_conv, position, role, text in zip(batch.conv, batch.no_conv, batch.position, batch.role, batch.text):
            if (conv, no_conv) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (conv, no_conv), hashlib.sha256()
            digest.update((f"\n{role}:{text}" if position else f"{role}:{text}").encode())
        if out:
            yield pd.DataFrame(out, columns=columns)
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=columns)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report on damaged rows (see :func:`damage`) - a row for each conversation, ``SIGNED`` without the signature, with
    cost and audit - and the repaired rows.

    Rows of a null conv_id are one conversation.  Rows are taken by turn, nulls first, then role and the text's hash;
    rows alike are duplicates.  Texts of any length are read whole; roles of other initials than s, u, a are re-roled or
    deleted.  An empty table gives no rows.
    """
    ship_code(rows.sparkSession)
    audited = staged(audits(sign(rows)), "repair-audits")
    return audited, repaired_rows(rows, audited)


def repair_report(turns: DataFrame) -> DataFrame:
    """Damages ``turns`` and repairs them: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the digest of
    the repaired rows as ``role:text``, joined by newlines, for every conv_id.

    A conversation without rows after damage has zeros, an empty audit and the digest of the empty string.  Extra columns
    are not read.
    """
    audited, fixed = repair(damage(turns))
    shas = fixed.select("conv", "no_conv", "position", "role", "text").mapInPandas(_digest, "d_conv string, d_no_conv boolean, sha string")
    joined = audited.join(shas, (F.col("conv") == F.col("d_conv")) & (F.col("no_conv") == F.col("d_no_conv")), "left")
    conv_id = F.when(~F.col("no_conv"), F.col("conv").cast("long"))
    return joined.select(conv_id.alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                         F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
