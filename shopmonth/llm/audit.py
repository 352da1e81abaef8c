"""Filter interaction audit: what each filter removes, alone and after others, in every order.

Each document gets five failure flags, and Spark counts the documents of a part by
their flags: 32 cells at most, whatever the size of the part. The cells of a part are
reshaped to a 2x2x2x2x2 tensor, pass and fail along the axis of each filter. What a
filter removes at some step is a contraction of that tensor: pass along the axes of
earlier filters, fail along its own, all along those of later ones. One ``einsum``
does all steps of all 120 orders.

The flags are built-in expressions over whole texts. Only a digest, the flags and the
part leave the scan; copies of a text are counted in the map tasks, and the table of
repeated texts is joined with the split of hot keys of ``join_facts``.

Defined results: a null text is empty, a null part is the empty string and shares its
part; a document without id is never a later copy and has no labels, and does not make
others copies; repeated rows are counted one by one, and copies of one id are no
later copies of each other; several labels of one id count as good or toxic if any is.
An empty table has no parts. Other columns are never looked at.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_facts
from ..sources.workdir import stage

FILTERS = "ABCDE"
# The limits of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SIGNS = "[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"

ORDERS = ["".join(order) for order in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def own_flags(text) -> dict:
    """Failure of the four filters that look at one text only."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n_words, n_chars = F.size(words).cast("long"), F.char_length(text).cast("long")
    capitals = n_chars - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n_words < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals > MOST_CAPITALS_PERCENT * n_chars,
        "D": text.rlike(SIGNS),
    }


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id, part, A … E`` of each document; staged, since the copies are looked up in it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = stage(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                             F.unhex(F.sha2(text, 256)).alias("digest"),
                             *[flag.alias(name) for name, flag in own_flags(text).items()]), "flags")
    first = (slim.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
             .where("first < last").select("digest", "first"))
    found = join_facts(slim, stage(first, "first"), "digest", "left")
    return found.select("id", "part", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("E"))


def cells(flags: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents, good and toxic ones, of each part and combination of failures (``cell``, A as its highest bit)."""
    known = (labels.groupBy(F.col(id_col).alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .where("id IS NOT NULL AND (good = 1 OR toxic = 1)"))
    cell = sum((F.col(name).cast("int") * (1 << (len(FILTERS) - 1 - k)) for k, name in enumerate(FILTERS)), F.lit(0))
    slim = stage(flags.select("id", "part", cell.alias("cell")), "cells")
    marked = join_facts(slim, stage(known, "known"), "id", "left")
    return marked.groupBy("part", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def selections(own, earlier, later) -> list[np.ndarray]:
    """For every step of every order, what is selected along each axis: five arrays (steps, 2)."""
    rows = [[own if name == order[step] else earlier if name in order[:step] else later for name in FILTERS]
            for order in ORDERS for step in range(len(FILTERS))]
    return list(np.array(rows, dtype=np.int64).transpose(1, 0, 2))


def contract(tensors: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """Sums of each tensor over each selection, (tensors, steps)."""
    return np.einsum("xabcde,na,nb,nc,nd,ne->xn", tensors, *chosen, optimize="greedy")


REMOVED = selections(FAIL, PASS, ALL)
KEPT = selections(PASS, PASS, ALL)
FAILING = selections(FAIL, ALL, ALL)
ONLY = selections(FAIL, PASS, PASS)


def steps_of_part(rows: pd.DataFrame) -> pd.DataFrame:
    """All steps of all orders of one part, from its at most 32 cells."""
    tensors = np.zeros((3, 1 << len(FILTERS)), dtype=np.int64)
    tensors[:, rows["cell"]] = rows[["n", "good", "toxic"]].to_numpy().T
    tensors = tensors.reshape(3, *[2] * len(FILTERS))
    removed, good_lost, toxic_lost = contract(tensors, REMOVED)
    totals = tensors[:1]
    own = np.array([[FILTERS.index(order[step]) for step in range(len(FILTERS))] for order in ORDERS]).ravel()
    shapley = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(shapley, own, removed)
    return pd.DataFrame({
        "part": rows["part"].iloc[0], "filter_order": np.repeat(ORDERS, len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
        "kept": contract(totals, KEPT)[0], "removed": removed, "redundant": contract(totals, FAILING)[0] - removed,
        "unique_fails": contract(totals, ONLY)[0], "good_lost": good_lost, "toxic_lost": toxic_lost, "shapley": shapley[own]})


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step."""
    counted = cells(flagged(docs, id_col, text_col, part_col), labels, id_col)
    return counted.groupBy("part").applyInPandas(steps_of_part, SCHEMA)
