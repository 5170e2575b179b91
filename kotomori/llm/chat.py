"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is a sequence of rows, each with one or more lines. A line's features (its
speaker marker, ends as a question, is short, ...) make one symbol, and the hidden state
is the role that speaks. A name counts as a speaker marker where speakers are announced:
on the first line of a row, behind a blank line, or in a row that was opened by a marker
of the same set of names. Elsewhere it is a word in a list, a heading or a quotation. Viterbi search over the whole
transcript gives the roles, and lines are rendered as canonical turns.

Viterbi steps are products in the algebra of maximum and sum, which can be bracketed at
will. Rows are sorted by transcript and place, whatever the lengths of transcripts, and
cut into blocks of ``fan`` rows. Going up, each block's share of a transcript becomes one
small matrix, ``fan`` of those become one again, and so on. Going down, the best path
fixes the roles at the borders of the shares of each level and, last, those of the lines.
So no task sees more than ``fan`` rows of a transcript at once, and a transcript that
holds a third of all rows is spread like any others.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotomori.llm.common import register, table
from kotomori.session import pin

ROLES = ("system", "user", "assistant")

# The speaker markers that are known, and the role each speaks for.
MARKERS = {
    "system": 0, "sys": 0, "instructions": 0, "instruction": 0, "context": 0,
    "user": 1, "human": 1, "customer": 1, "question": 1, "q": 1, "me": 1, "prompt": 1, "student": 1,
    "assistant": 2, "ai": 2, "bot": 2, "agent": 2, "answer": 2, "a": 2, "model": 2, "response": 2, "teacher": 2,
}
MARKER = re.compile(
    r"^\s*(?P<open>[#>*\-\[<|(]{0,4})\s*(?P<name>" + "|".join(sorted(MARKERS, key=len, reverse=True)) + r")\s*(?P<close>[\])>|*]{0,4})\s*(?P<mark>:|-{1,2}>|\||\n|$)\s*(?:\*{1,2}\s*)?",
    re.IGNORECASE,
)
# Names that are used together.
SETS = (
    {"system", "sys", "user", "assistant"}, {"human", "ai", "assistant", "system"}, {"q", "a"}, {"question", "answer", "context"},
    {"instruction", "instructions", "prompt", "response", "context"}, {"customer", "agent"}, {"student", "teacher"}, {"user", "model", "bot", "system"}, {"me", "bot", "ai"},
)


@dataclass(frozen=True)
class ChatSettings:
    #: Role probabilities of what stands before the first row, from which that row is one step on.
    start: tuple[float, ...] = (0.6, 0.05, 0.35)
    #: Role -> role between a row's lines, and from one row to the next.
    within: tuple[tuple[float, ...], ...] = ((0.98, 0.01, 0.01), (0.01, 0.97, 0.02), (0.01, 0.02, 0.97))
    between: tuple[tuple[float, ...], ...] = ((0.1, 0.85, 0.05), (0.01, 0.09, 0.9), (0.01, 0.9, 0.09))
    #: How likely another role is on a blank line, or on the one below a marker on a line of its own.
    passed: float = 1e-3
    #: How likely a marker of a role is on a line of that role, and on another's.
    marked: float = 0.6
    mismarked: float = 2e-5
    #: Share of lines of each role that end as a question, are short, and open with an instruction.
    question: tuple[float, ...] = (0.02, 0.45, 0.1)
    short: tuple[float, ...] = (0.4, 0.4, 0.2)
    told: tuple[float, ...] = (0.5, 0.03, 0.01)
    short_chars: int = 120
    #: Rows in a block, and shares that are chained at a time.
    fan: int = 256


TOLD = re.compile(r"^\s*(?:you are|you must|always|never|do not|respond|reply|act as)\b", re.IGNORECASE)


def announces(marker: re.Match, first: re.Match | None, opens: bool, behind: bool) -> bool:
    """Whether a name at the head of a line stands for a speaker: by its form, and by its
    place (``opens``: first line of its row; ``behind``: after a blank line; ``first``: the
    marker that opened the row)."""
    colon = marker["mark"] in (":", "->", "-->")
    tagged = marker["open"][-1:] in ("[", "<", "|", "(") and marker["close"][:1] in ("]", ">", "|", ")") and marker["close"] != ""
    if opens:
        return colon or tagged or marker["open"][:1] not in ("-", "*", "|")
    alike = first is not None and first["open"] == marker["open"] and any({first["name"].lower(), marker["name"].lower()} <= s for s in SETS)
    return (colon or tagged) and (behind or alike)


def emission(line: str, marker: re.Match | None, settings: ChatSettings) -> tuple[np.ndarray, str, int | None]:
    """Log likelihood of a line for each role, the line without its speaker marker, and
    the marker's role."""
    rest = line[marker.end() :] if marker else line
    role = MARKERS[marker["name"].lower()] if marker else None
    seen = np.zeros(len(ROLES))
    for r in range(len(ROLES)):
        p = (settings.marked if role == r else settings.mismarked) if marker else 1 - settings.marked
        for is_, share in ((rest.rstrip().endswith("?"), settings.question[r]), (len(rest) < settings.short_chars, settings.short[r]), (bool(TOLD.match(rest)), settings.told[r])):
            p *= share if is_ else 1 - share
        seen[r] = np.log(p)
    return seen, rest, role


#: A line as written, its words after the marker (None: it has none), and the marker's role.
Line = tuple[str, str | None, int | None]


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the algebra of maximum and sum."""
    return (a[:, :, None] + b[None]).max(axis=1)


def steps(text: str, settings: ChatSettings) -> tuple[list[np.ndarray], list[Line]]:
    """The matrix of each line of a row (role before -> role of the line), and its words."""
    within, between = np.log(settings.within), np.log(settings.between)
    owed = np.log(np.where(np.eye(len(ROLES)) == 1, 1 - settings.passed, settings.passed / (len(ROLES) - 1)))
    matrices, lines, first, behind, alone = [], [], None, False, False
    for i, line in enumerate(text.split("\n")):
        marker = MARKER.match(line)
        if marker and not announces(marker, first, i == 0, behind):
            marker = None
        if i == 0:
            first = marker
        behind = not line.strip()
        seen, rest, role = emission(line, marker, settings)
        matrices.append((between if not i else owed if alone or behind else within) + seen[None])
        alone = rest != line and not rest.strip() and "\n" in text  # a marker on a line of its own says nothing more
        lines.append((line, None if alone else rest, role))
    return matrices, lines


def best_path(before: np.ndarray, matrices: list[np.ndarray], out: int) -> list[int]:
    """The role after each matrix, given scores of the role before them and the last
    role (-1: free). Of equal scores the first role wins, from the end backwards."""
    score, back = before, []
    for m in matrices:
        paths = score[:, None] + m
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0)
    role = int(score.argmax()) if out < 0 else out
    roles = []
    for b in reversed(back):
        roles.append(role)
        role = int(b[role])
    return roles[::-1]


def border(role: int, settings: ChatSettings) -> np.ndarray:
    """Scores of the role before a share: a known role, or the start of a transcript (-1)."""
    return np.log(settings.start) if role < 0 else np.where(np.arange(len(ROLES)) == role, 0.0, -np.inf)


def rendered(roles: list[int], lines: list[Line], previous: int, closes: bool) -> str:
    """Canonical turns of a row's lines, each opened where the role changes.

    A marker goes where it opens a turn of its role; elsewhere it is part of the words.
    """
    out = []
    for role, (line, rest, marker) in zip(roles, lines):
        said = rest if role != previous and marker == role else line
        if role != previous:
            out.append("<|end|>\n" if previous >= 0 else "")
            out.append(f"<|{ROLES[role]}|>\n")
        if said is not None:
            out.append(said + "\n")
        previous = role
    return "".join(out) + ("<|end|>\n" if closes else "")


def as_matrices(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(m).reshape(len(ROLES), len(ROLES)) for m in column]


def names(group: pd.DataFrame, by: str):
    """The rows of each transcript in a block, in order."""
    for name, part in group.sort_values(by).groupby("name", sort=False):
        yield name, part


def bordered(shares: DataFrame, settings: ChatSettings) -> DataFrame:
    """``(name, block, role_in, role_out)`` for shares ``(name, block, matrix)``: the roles
    at their borders on the best path; -1 at both ends of a transcript."""
    kinds = "name string, block long, role_in int, role_out int"
    counted = shares.groupBy("name").count()
    most = counted.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    alone = counted.where("count = 1").select("name").join(shares, "name").select("name", "block", F.lit(-1).alias("role_in"), F.lit(-1).alias("role_out"))
    several = counted.where("count > 1").select("name").join(shares, "name")
    if most <= 1:
        return alone

    def down(group: pd.DataFrame) -> pd.DataFrame:
        done = []
        for name, part in names(group, "block"):
            first, last = int(part["role_in"].iloc[0]), int(part["role_out"].iloc[0])
            roles = best_path(border(first, settings), as_matrices(part["matrix"]), last)
            done.append(pd.DataFrame({"name": name, "block": part["block"], "role_in": [first, *roles[:-1]], "role_out": [*roles[:-1], last]}))
        return pd.concat(done)

    if most <= settings.fan:
        tops = several.select("name", "block", "matrix", F.lit(-1).alias("role_in"), F.lit(-1).alias("role_out"))
        return alone.unionByName(tops.groupBy("name").applyInPandas(down, kinds))

    def up(group: pd.DataFrame) -> pd.DataFrame:
        done = [(name, part["upper"].iloc[0], reduce(chain, as_matrices(part["matrix"])).tobytes()) for name, part in names(group, "block")]
        return pd.DataFrame(done, columns=["name", "block", "matrix"])

    lower = several.withColumn("upper", F.floor(F.col("block") / settings.fan))
    uppers = pin(lower.groupBy("upper").applyInPandas(up, "name string, block long, matrix binary"), "chat-shares")
    roles = bordered(uppers, settings).withColumnRenamed("block", "upper")
    return alone.unionByName(lower.join(roles, ["name", "upper"]).groupBy("upper").applyInPandas(down, kinds))


def format_chats(rows: DataFrame, settings: ChatSettings, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``(conv, turn, n_lines, first_role, last_role, rendered)``, a row for each row.

    Rows of a transcript are ordered by ``turn``, then text; the texts in ``rendered``, put
    together in that order, are its canonical form. A null or empty text is one empty
    line. Rows with a null ``conv`` form one transcript, null turns come first; repeated
    rows are spoken twice. Very long texts are one row each and are never cut. An empty
    table gives no rows, and other columns, of whatever names, are not read.
    """
    typed = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    named = typed.withColumn("name", F.to_json(F.struct("conv"))).withColumn("tie", F.xxhash64("text"))  # a name for a key of any type, null too
    order = ["name", "turn", "tie", "text"]
    ordered = named.repartitionByRange(*order[:3]).sortWithinPartitions(*order).drop("tie")
    block = F.floor(F.monotonically_increasing_id() / settings.fan)
    placed = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("block", block)
    # Writing fixes the places; keys pass pandas as strings, which holds nulls and long numbers.
    placed = pin(placed.withColumns({c: F.col(c).cast("string") for c in ("conv", "turn")}), "transcripts")

    def up(group: pd.DataFrame) -> pd.DataFrame:
        done = [(name, part["block"].iloc[0], reduce(chain, [m for t in part["text"] for m in steps(t, settings)[0]]).tobytes()) for name, part in names(group, "at")]
        return pd.DataFrame(done, columns=["name", "block", "matrix"])

    shares = placed.select("name", "block", "at", "text").groupBy("block").applyInPandas(up, "name string, block long, matrix binary")
    borders = pin(bordered(pin(shares, "chat-shares"), settings), "chat-borders")

    def speak(group: pd.DataFrame) -> pd.DataFrame:
        done = []
        for _, part in names(group, "at"):
            previous, last = int(part["role_in"].iloc[0]), int(part["role_out"].iloc[0])
            parsed = [steps(t, settings) for t in part["text"]]
            roles = best_path(border(previous, settings), [m for p in parsed for m in p[0]], last)
            start, out = 0, []
            for i, (_, lines) in enumerate(parsed):
                mine = roles[start : start + len(lines)]
                said = rendered(mine, lines, previous, closes=i + 1 == len(parsed) and last < 0)
                out.append((len(lines), ROLES[mine[0]], ROLES[mine[-1]], said))
                previous, start = mine[-1], start + len(lines)
            done.append(pd.DataFrame(out, columns=["n_lines", "first_role", "last_role", "rendered"], index=part.index).assign(conv=part["conv"], turn=part["turn"]))
        return pd.concat(done)[["conv", "turn", "n_lines", "first_role", "last_role", "rendered"]]

    kinds = dict(typed.dtypes)
    spoken = "conv string, turn string, n_lines int, first_role string, last_role string, rendered string"
    out = placed.join(borders, ["name", "block"]).groupBy("block").applyInPandas(speak, spoken)
    return out.withColumns({c: F.col(c).cast(kinds[c]) for c in ("conv", "turn")}).withColumnsRenamed({"conv": conv, "turn": turn})


def as_transcript(rows: DataFrame) -> DataFrame:
    """Conversations written down as transcripts: by the hash of its place, a turn bears
    one of several speaker markers or none."""
    marks = [("Human: ", "AI: ", "Context: "), ("### User:\n", "### Assistant:\n", "### System:\n"), ("Q: ", "A: ", "Instructions: "), ("", "", "")]
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(len(marks)))
    by_role = [F.when(F.col("role") == "user", u).when(F.col("role") == "assistant", a).when(F.col("role") == "system", s).otherwise("") for u, a, s in marks]
    return rows.withColumn("text", F.concat(F.get(F.array(*by_role), style.cast("int")), F.coalesce("text", F.lit(""))))


@register("op1_chat")
def op1_chat(spark: SparkSession, sf: str) -> DataFrame:
    return format_chats(as_transcript(table(spark, sf, "conversations")), ChatSettings())
