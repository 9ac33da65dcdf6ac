"""Recovers the roles in chat transcripts and renders them canonically.

A transcript is a conversation's segments in order, each some lines. What a line shows (a speaker marker,
its length, a question mark, whether it opens a segment) is the observation of a hidden Markov model whose
states are the roles; roles change where a segment opens. The model is counted from conversations with
known roles. Viterbi decoding runs in blocks: each block of segments gives, for every role before it, the
best score of every role at its end. These small tables chain the blocks of a conversation in the product
of maximum and sum, so that a conversation of any length is decoded by many tasks and exactly.

A null text is empty and has one line. Segments without a conversation or a position are rendered as the
role that the model finds likeliest for them alone. Repeated (conversation, position) pairs are ordered by
their text. Roles outside ``ROLES`` are not learnt from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
BLOCK = 256

# The words that mark a speaker, by role.
MARKERS = {
    "system": ("system", "instructions", "sys"),
    "user": ("user", "human", "you", "q", "customer"),
    "assistant": ("assistant", "ai", "bot", "a", "model", "agent"),
}
_MARK = re.compile(
    r"^[\x20\x09]*(?:#{1,6}\x20*|\*\*|<\|(?:im_start\|>)?|\[)?("
    + "|".join(sorted((w for ws in MARKERS.values() for w in ws), key=len, reverse=True))
    + r")(?:\x20\([^)\n]{0,40}\))?(?:\*\*:|:\*\*|\|>|\]:?|:|(?=\x20*$))[\x20\x09]*",
    re.IGNORECASE,
)
_ROLE = {word: role for role, words in MARKERS.items() for word in words}
N_OPEN, N_LENGTH = 4, 8


def marker(line: str) -> tuple[int, str]:
    """(1 + number of the role that the line's marker names, or 0; the line without its marker)."""
    m = _MARK.match(line)
    if not m:
        return 0, line
    # A word alone is a marker only if it is more than a letter or two.
    if not re.search(r"[:|\]*#]", m.group()) and len(m[1]) < 4:
        return 0, line
    return 1 + ROLES.index(_ROLE[m[1].lower()]), line[m.end():]


def observe(text: str | None) -> tuple[list[int], list[str]]:
    """Per line, a number that holds its marker, its length class and its question mark; and the bare lines."""
    seen, bare = [], []
    for line in (text or "").split("\n"):
        mark, rest = marker(line)
        size = min(len(rest).bit_length() // 2, 3)
        seen.append(mark * N_LENGTH + size * 2 + ("?" in rest))
        bare.append(rest)
    return seen, bare


def train(segments: DataFrame, key: str, order: str, text: str, role: str) -> dict[str, np.ndarray]:
    """Log probabilities of first roles, moves and observations, counted with one added everywhere."""
    rows = segments.where(F.col(role).isin(*ROLES)).select(
        F.col(key).alias("key"), F.col(order).alias("order"), F.col(text).alias("text"), F.col(role).alias("role")
    )
    before = F.lag("role").over(Window.partitionBy("key").orderBy("order"))
    moves = {
        (r["before"], r["role"]): r["count"]
        for r in rows.select(before.alias("before"), "role").groupBy("before", "role").count().collect()
    }

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, seen = [], []
            for role, t in zip(*(c.to_pylist() for c in batch.columns)):
                own, _ = observe(t)
                seen += [2 * o + (k == 0) for k, o in enumerate(own)]
                roles += [role] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(roles, pa.string()), pa.array(seen, pa.int32())], ["role", "seen"])

    emitted = rows.select("role", "text").mapInArrow(lines, "role string, seen int").groupBy("role", "seen").count()
    start = np.ones(len(ROLES))
    move = np.ones((len(ROLES), len(ROLES)))
    emit = np.full((len(ROLES), 2 * N_OPEN * N_LENGTH), 0.5)
    for (a, b), n in moves.items():
        if a is None:
            start[ROLES.index(b)] += n
        else:
            move[ROLES.index(a), ROLES.index(b)] += n
    for r in emitted.collect():  # roles times observations
        emit[ROLES.index(r["role"]), r["seen"]] += r["count"]
    return {
        "start": np.log(start / start.sum()),
        "move": np.log(move / move.sum(axis=1, keepdims=True)),
        "emit": np.log(emit / emit.sum(axis=1, keepdims=True)),
    }


def segment_scores(text: str | None, model: dict[str, np.ndarray]) -> np.ndarray:
    """Log probability of the segment's lines under each role. A role holds for a segment."""
    seen, _ = observe(text)
    codes = np.array([2 * o + (k == 0) for k, o in enumerate(seen)])
    return model["emit"][:, codes].sum(axis=1)


def render(role: str, text: str | None) -> str:
    """The canonical turn: role in its marker, the text without the marker that opens it, and an end mark.
    Lines further down that look marked are content and stay."""
    first, *rest = (text or "").split("\n")
    return f"<|{role}|>\n" + "\n".join([marker(first)[1], *rest]).strip(" \t\n\x0b\x0c\r") + "\n<|end|>\n"


def parse(
    segments: DataFrame, model: dict[str, np.ndarray], key: str, order: str, text: str, block: int = BLOCK,
) -> DataFrame:
    """``segments`` with ``found_role`` and ``turn_text``; columns of these names are replaced."""
    n = len(ROLES)
    segments = segments.drop("found_role", "turn_text")
    names = segments.columns

    @F.pandas_udf("array<double>")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([segment_scores(t, model).tolist() for t in texts])

    placed = F.col(key).isNotNull() & F.col(order).isNotNull()
    rows = segments.withColumn("__score", scores(F.col(text))).withColumn("__placed", placed)
    # Blocks are ranges of the position, cut where a position's own block would grow too large.
    rows = rows.withColumns({
        "__key": F.when(placed, F.col(key).cast("string")),
        "__block": F.floor(F.col(order) / F.lit(block)).cast("long"),
    })
    alone = rows.where(~F.col("__placed"))
    rows = rows.where("__placed").withColumns({"__order": F.col(order).cast("double"), "__text": F.md5(F.coalesce(F.col(text), F.lit("")))})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """Best score from each role before the block to each role at its end."""
        pdf = pdf.sort_values(["__order", "__text"], kind="stable")
        total = None
        for own in pdf["__score"]:
            step = model["move"] + np.asarray(own)[None, :]
            total = step if total is None else (total[:, :, None] + step[None]).max(axis=1)
        first = pdf.iloc[0]
        start = model["start"] + np.asarray(first["__score"])
        opening = start
        for own in list(pdf["__score"])[1:]:
            opening = (opening[:, None] + model["move"]).max(axis=0) + np.asarray(own)
        return pd.DataFrame({
            "__key": [first["__key"]], "__block": [first["__block"]],
            "table": [total.ravel().tolist()], "opening": [opening.tolist()],
        })

    tables = rows.select("__key", "__block", "__order", "__text", "__score").groupBy("__key", "__block").applyInPandas(
        chain, "__key string, __block long, table array<double>, opening array<double>"
    )

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        """The role at the end of every block: the only thing a block needs of the later ones."""
        pdf = pdf.sort_values("__block")
        tables = [np.asarray(t).reshape(n, n) for t in pdf["table"]]
        best = [np.asarray(pdf["opening"].iloc[0])]
        for t in tables[1:]:
            best.append((best[-1][:, None] + t).max(axis=0))
        state = int(best[-1].argmax())
        last = [state]
        for k in range(len(tables) - 1, 0, -1):
            state = int((best[k - 1] + tables[k][:, state]).argmax())
            last.append(state)
        last = last[::-1]
        return pd.DataFrame({
            "__key": pdf["__key"], "__block": pdf["__block"],
            "__before": [-1, *last[:-1]], "__last": last,
        })

    # One row a block: a conversation's are as many as its segments over the block length.
    known = tables.groupBy("__key").applyInPandas(ends, "__key string, __block long, __before int, __last int")

    def decode(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__order", "__text"], kind="stable")
        own = np.stack([np.asarray(s) for s in pdf["__score"]])
        before, last = int(pdf["__before"].iloc[0]), int(pdf["__last"].iloc[0])
        best = own[0] + (model["start"] if before < 0 else model["move"][before])
        back = np.zeros(own.shape, np.int64)
        for k in range(1, len(own)):
            ways = best[:, None] + model["move"]
            back[k] = ways.argmax(axis=0)
            best = ways.max(axis=0) + own[k]
        roles = [last]
        for k in range(len(own) - 1, 0, -1):
            roles.append(int(back[k, roles[-1]]))
        found = [ROLES[r] for r in roles[::-1]]
        return pdf[["__id"]].assign(found_role=found)

    # The texts wait under a row name while the scores travel.
    rows = rows.withColumn("__id", F.concat_ws(":", "__key", F.col("__order").cast("string"), "__text"))
    light = rows.select("__id", "__key", "__block", "__order", "__text", "__score").join(known, ["__key", "__block"])
    decoded = light.groupBy("__key", "__block").applyInPandas(decode, "__id string, found_role string")
    decoded = decoded.groupBy("__id").agg(F.min("found_role").alias("found_role"))
    joined = rows.join(decoded, "__id").select(*[F.col(f"`{c}`") for c in names], "found_role")
    likeliest = F.array(*[F.lit(r) for r in ROLES])[
        F.array_position("__score", F.array_max("__score")).cast("int") - 1
    ]
    alone = alone.withColumn("found_role", likeliest).select(*[F.col(f"`{c}`") for c in names], "found_role")

    @F.pandas_udf("string")
    def rendered(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([render(r, t) for r, t in zip(roles, texts)])

    return joined.unionByName(alone).withColumn("turn_text", rendered("found_role", F.col(text)))


def transcript_text(role: Column, text: Column, key: Column, order: Column, unmarked: int = 4) -> Column:
    """A turn as a transcript may show it: marked in one of some styles, or, once in ``unmarked``, bare."""
    style = F.pmod(F.xxhash64(key), F.lit(3))
    title = F.initcap(role)
    marked = (
        F.when(style == 0, F.concat(title, F.lit(": "), text))
        .when(style == 1, F.concat(F.lit("### "), title, F.lit(":\n"), text))
        .otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n"), text))
    )
    bare = F.pmod(F.xxhash64(key, order), F.lit(unmarked)) == 0
    return F.when(bare | role.isNull(), text).otherwise(F.coalesce(marked, text))
