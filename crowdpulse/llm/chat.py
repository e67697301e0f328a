"""Chat formatting into budgeted, turn-aligned training windows with a loss mask.

A conversation's turns are read in order; running sums of their token counts decide where a window ends: as many whole
turns as fit the budget beside the system turn and the repeated history. Each further window opens with the system turn and
at most ``history`` of the latest turns, as far as they fit into half of what the system turn leaves; those repeats carry no
loss, so each assistant text is learned exactly once. A turn larger than the budget has a window of its own and is kept whole. A system turn of more than
half the budget would leave its windows little room: there (``stretch``) a window goes on past the budget until its other
turns have as many tokens as the system turn. So the output stays within eight times the input, marks apart, and mostly far below.

Turns are marked ``<|turn:ROLE|>`` ... ``<|end|>``. Control strings inside texts (this template's and other common ones)
are broken by a backslash, and backslashes doubled, so that a text can neither open nor close a turn and comes back exactly.

A conversation of more tokens than a block (``BLOCK`` budgets, or four of its system turns if these are larger) is cut into
blocks at multiples of that sum, and a window ends where its block does. Turns are sorted over range partitions, their
running sums carried from one partition to the next, and each block is formatted by itself: it opens with the system turn and
the latest turns before it, as any further window. So no task has a whole long conversation, and turns are streamed:
only the open window, the system turn and the history are held. ``digests`` reads windows back one by one; only the
digests of a whole conversation, which are sequential, take its texts through one task.

Defined cases: null texts are empty, null roles the empty role; turns sort by number (null first), then role and text,
and repeated rows are turns of their own; rows with a null conv_id form one conversation; a first turn of role "system"
is the system turn; an empty table gives no windows. Ties between equal rows of a long conversation are told apart by their
place in the input, which should be a table (or anything else that Spark computes alike twice).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import held_bytes, small, stash

# Strings that some chat template reads as control.
CONTROL = re.compile(r"<\||</?s>|\[/?INST\]|<</?SYS>>|<(?:start|end)_of_turn>")
#: A block has as many tokens as this many budgets, at least.
BLOCK = 64
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<\|turn:([^|]*)\|>(.*?)<\|end\|>", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "|" if m[1] == "p" else m[1], text)


def marked(role: str, text: str) -> tuple[str, str, str]:
    return "<|turn:" + role.replace("\\", "\\\\").replace("|", "\\p") + "|>", escape(text), "<|end|>"


def turns_of(window: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in TURN.finditer(window)]


def tokens(text: str) -> int:
    """A token estimate that needs no vocabulary: four UTF-8 bytes each."""
    return 4 + len(text.encode("utf-8", "surrogatepass")) // 4


def tokens_of(text: Column) -> Column:
    """The same estimate as a column."""
    return F.lit(4) + F.floor(F.octet_length(text) / 4)


class Windows:
    """The windows of one conversation, fed turn by turn. ``stretch`` lets a window that a large system turn opens go on past
    the budget; without it only a single turn can exceed the budget."""

    def __init__(self, budget: int, history: int, stretch: bool = False):
        self.budget, self.history, self.stretch = budget, history, stretch
        self.system: tuple[str, str, int] | None = None
        self.recent: list[tuple[str, str, int]] = []
        self.open: list[tuple[str, str, int]] = []
        self.repeated = 0       # leading turns of the open window that an earlier window has
        self.first = self.next = 0      # positions of the open window's first own turn and of the next turn
        self.sum = 0

    def resume(self, system: tuple[str, str] | None, recent: list[tuple[str, str]], position: int) -> None:
        """Go on at ``position``, after these latest turns."""
        self.system = system and (*system, tokens(system[1]))
        self.recent = [(*t, tokens(t[1])) for t in recent]
        self.first = self.next = position

    def add(self, role: str, text: str) -> list[tuple]:
        turn = (role, text, tokens(text))
        out = []
        if len(self.open) > self.repeated and self.sum + turn[2] > self.budget and self._worth_closing():
            out.append(self.close())
        if not self.next and role == "system":
            self.system = turn
        elif self.next and not self.open:
            self._reopen(turn[2])
        self.open.append(turn)
        self.sum += turn[2]
        self.next += 1
        if turn is not self.system and self.history:
            self.recent = [*self.recent, turn][-self.history:]
        return out

    def _worth_closing(self) -> bool:
        """The next window repeats the system turn; where that takes over half the budget, this one holds as much besides."""
        system = self.system[2] if self.system else 0
        return not self.stretch or 2 * system <= self.budget or self.sum >= 2 * system

    def _reopen(self, needed: int) -> None:
        """Begin a window: the system turn, and the latest turns while they and the next turn fit."""
        self.open = [self.system] if self.system else []
        self.sum = sum(t[2] for t in self.open)
        repeat, most = [], self.sum + (self.budget - self.sum) // 2
        for t in reversed(self.recent):
            if self.sum + t[2] > most or self.sum + t[2] + needed > self.budget:
                break
            repeat.insert(0, t)
            self.sum += t[2]
        self.open += repeat
        self.repeated = len(self.open)

    def close(self) -> tuple:
        """(position of its first own turn, text, repeated turns, mask starts, mask ends) of the open window."""
        parts, starts, ends, at = [], [], [], 0
        for i, (role, text, _) in enumerate(self.open):
            head, body, tail = marked(role, text)
            if role == "assistant" and i >= self.repeated:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts += [head, body, tail]
            at += len(head) + len(body) + len(tail)
        done = (self.first, "".join(parts), self.repeated, starts, ends)
        self.first, self.open, self.repeated, self.sum = self.next, [], 0, 0
        return done


COLUMNS = ["conv", "nothing", "window", "text", "repeated", "starts", "ends"]
WINDOW_DDL = "conv long, nothing boolean, window long, text string, repeated int, starts array<int>, ends array<int>"
CONVERSATION = ["conv", "nothing"]
SYSTEM, EARLIER, OWN = 0, 1, 2


def _format(budget: int, history: int, stretch: bool, rows: int = 256):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, out = None, None, []
        system, recent = None, []
        for b in batches:
            for conv, nothing, block, kind, pos, role, text in zip(*(b[c] for c in ("conv", "nothing", "block", "kind", "pos", "role", "text")), strict=True):
                if (conv, nothing, block) != key:
                    if state is not None:
                        out.append((*key[:2], *state.close()))
                    key, state, system, recent = (conv, nothing, block), None, None, []
                if kind == SYSTEM:
                    system = (role, text)
                    continue
                if kind == EARLIER:
                    recent.append((role, text))
                    continue
                if state is None:
                    state = Windows(budget, history, stretch)
                    if block:
                        state.resume(system, recent, pos)
                out += [(conv, nothing, *w) for w in state.add(role, text)]
                if len(out) >= rows:
                    yield pd.DataFrame(out, columns=COLUMNS)
                    out = []
        if state is not None:
            out.append((*key[:2], *state.close()))
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)
    return run


SUMMED_DDL = "conv long, nothing boolean, role string, text string, span long, part int, place long, before long, size long"


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each turn's place and the tokens before it among its conversation's turns in this partition."""
    part, key, place, before = TaskContext.get().partitionId(), None, 0, 0
    for b in batches:
        out = []
        for conv, nothing, role, text, span in zip(*(b[c] for c in ("conv", "nothing", "role", "text", "span")), strict=True):
            if (conv, nothing) != key:
                key, place, before = (conv, nothing), 0, 0
            size = tokens(text)
            out.append((conv, nothing, role, text, span, part, place, before, size))
            place, before = place + 1, before + size
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SUMMED_DDL.split(", ")])


def placed(turns: DataFrame) -> DataFrame:
    """conv, nothing, role, text, pos, block: the turns with their position and their block of ``span`` tokens."""
    order = ["conv", "nothing", "turn", "role", "text", "copy"]
    ranged = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    summed = stash(ranged.select("conv", "nothing", "role", "text", "span").mapInPandas(_running, SUMMED_DDL), "chat-turns")
    up_to = Window.partitionBy(*CONVERSATION).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = summed.groupBy(*CONVERSATION, "part").agg(F.count(F.lit(1)).alias("turns"), F.sum("size").alias("tokens"))
    carried = stash(parts.select(*CONVERSATION, "part", F.coalesce(F.sum("turns").over(up_to), F.lit(0)).alias("turns"),
                                 F.coalesce(F.sum("tokens").over(up_to), F.lit(0)).alias("tokens")), "chat-sums")
    return summed.join(small(carried, held_bytes(carried)), [*CONVERSATION, "part"]).select(
        *CONVERSATION, "role", "text", (F.col("turns") + F.col("place")).alias("pos"),
        F.expr("(tokens + before) div span").alias("block"))


def _openings(rows: DataFrame, history: int) -> DataFrame:
    """What further blocks open with: the system turn, and the latest turns before them."""
    blocks = rows.groupBy(*CONVERSATION, "block").agg(F.min("pos").alias("first")).where("block > 0")
    begin = F.greatest(F.col("first") - history, F.lit(0))
    wanted = blocks.withColumn("pos", F.explode(F.array_union(F.array(F.lit(0).cast("long")), F.slice(F.sequence(begin, F.col("first")), F.lit(1), (F.col("first") - begin).cast("int")))))
    found = rows.drop("block").join(wanted, [*CONVERSATION, "pos"])
    system = (F.col("pos") == 0) & (F.col("role") == "system")
    return (found.where(system | (F.col("pos") >= F.col("first") - history))
            .select(*CONVERSATION, "block", F.when(system, SYSTEM).otherwise(EARLIER).alias("kind"), "pos", "role", "text"))


def windows(conversations: DataFrame, budget: int = 1024, history: int = 2, stretch: bool = True) -> DataFrame:
    """conv_id, window, text, repeated, starts, ends: the formatted windows and their loss spans (code points). ``window`` is the
    position of its first turn that is no repeat, from 0."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("nothing"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = turns.select(*CONVERSATION, "role", tokens_of(F.col("text")).alias("size")).groupBy(*CONVERSATION).agg(
        F.sum("size").alias("size"), F.coalesce(F.max(F.when(F.col("role") == "system", F.col("size"))), F.lit(0)).alias("system"))
    span = F.greatest(F.lit(BLOCK * budget).cast("long"), 4 * F.col("system"))
    long = stash(sizes.withColumn("span", span).where("size > span").select(*CONVERSATION, "span"), "chat-long")
    dealt = turns.join(small(long, held_bytes(long)), CONVERSATION, "left")
    whole = dealt.where("span IS NULL").select(*CONVERSATION, F.lit(0).cast("long").alias("block"), F.lit(OWN).alias("kind"),
                                               F.lit(0).cast("long").alias("pos"), "turn", "role", "text")
    cut = placed(dealt.where("span IS NOT NULL"))
    own = cut.select(*CONVERSATION, "block", F.lit(OWN).alias("kind"), "pos", "role", "text")
    parts = own.unionByName(_openings(cut, history)).withColumn("turn", F.lit(None).cast("long"))
    made = (whole.unionByName(parts).repartition("conv", "nothing", "block")
            .sortWithinPartitions("conv", "nothing", "block", "kind", "pos", "turn", "role", "text")
            .select("conv", "nothing", "block", "kind", "pos", "role", "text").mapInPandas(_format(budget, history, stretch), WINDOW_DDL))
    return made.select(F.when(~F.col("nothing"), F.col("conv")).alias("conv_id"), "window", "text", "repeated", "starts", "ends")


SAID_DDL = "conv long, nothing boolean, window long, turns long, chars long, said string, starts array<int>, ends array<int>"


def _said(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each window's own turns, read back, and the places of what its loss mask shows."""
    for b in batches:
        out = []
        for conv, nothing, window, text, repeated, starts, ends in zip(*(b[c] for c in COLUMNS), strict=True):
            masked = dict(zip(starts, ends, strict=True))
            said, begin, end, at, turns = [], [], [], 0, 0
            for i, m in enumerate(TURN.finditer(text)):
                if i < repeated:
                    continue
                role, body = unescape(m[1]) + "\n", unescape(m[2])
                if m.start(2) in masked:
                    learned = unescape(text[m.start(2):masked.pop(m.start(2))])
                    begin.append(at + len(role))
                    end.append(at + len(role) + len(learned))
                said += [role, body, "\n"]
                at += len(role) + len(body) + 1
                turns += 1
            if masked:
                raise ValueError(f"conversation {conv}: a loss span that begins at no turn")
            out.append((conv, nothing, window, turns, len(text), "".join(said), begin, end))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SAID_DDL.split(", ")])


class _Reading:
    """What one conversation's windows say, read in order."""

    def __init__(self):
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, turns: int, chars: int, said: str, starts, ends) -> None:
        self.turns += turns
        self.chars += chars
        self.said.update(said.encode("utf-8", "surrogatepass"))
        for a, z in zip(starts, ends, strict=True):
            self.loss_chars += z - a
            self.learned.update(said[a:z].encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


DIGEST_DDL = ("conv long, nothing boolean, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in DIGEST_DDL.split(", ")]
    key, state = None, None
    for b in batches:
        out = []
        for conv, nothing, turns, chars, said, starts, ends in zip(*(b[c] for c in ("conv", "nothing", "turns", "chars", "said", "starts", "ends")), strict=True):
            if (conv, nothing) != key:
                if state is not None:
                    out.append((*key, *state.row()))
                key, state = (conv, nothing), _Reading()
            state.read(turns, chars, said, starts, ends)
        if out:
            yield pd.DataFrame(out, columns=names)
    if state is not None:
        yield pd.DataFrame([(*key, *state.row())], columns=names)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, their digest, the text under the loss mask, characters."""
    keyed = formatted.select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("nothing"),
                             "window", "text", "repeated", "starts", "ends")
    read = (keyed.mapInPandas(_said, SAID_DDL).repartition("conv", "nothing").sortWithinPartitions("conv", "nothing", "window")
            .select("conv", "nothing", "turns", "chars", "said", "starts", "ends").mapInPandas(_digest, DIGEST_DDL))
    return read.select(F.when(~F.col("nothing"), F.col("conv")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars",
                       "loss_sha256", "formatted_chars")
