"""What filters remove in every order of applying them, from path counts over the lattice of their subsets.

A state is the set of filters that have been applied, an edge applies one more.  What an edge removes follows
from how many documents fail which filters, whatever the way to its state.  So documents are counted
once by the set of filters they fail, the orders that reach and leave each state are counted forwards and
backwards, and both shares and the steps of every single order are read from the same edges.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.stored import stored

#: More filters have too many orders to list: 7 have 5,040.
MOST_FILTERS = 7


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """For every state (a bit for each applied filter): how many orders of filters lead to it from none, and from it to all."""
    states = 1 << filters
    forward, backward = [0] * states, [0] * states
    forward[0] = backward[-1] = 1
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def failures(docs: DataFrame, rules: dict[str, Column], text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """How often an id stands with a text: id, fp (of the text), part, mask (a bit for each of ``rules`` that is true), n.

    Rules look at the text only and never at other rows; a null rule is one that the document does not fail.
    Null texts are empty, and null parts the empty string.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bits = [F.when(rule, F.lit(1 << i)).otherwise(0) for i, rule in enumerate(rules.values())]
    mask = reduce(lambda a, b: a + b, bits, F.lit(0)).alias("mask")
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("fp"), part, mask)
    return rows.groupBy("id", "fp", "part", "mask").agg(F.count(F.lit(1)).alias("n"))


def profile(found: DataFrame, labels: DataFrame, copies: int, marks: dict[str, Column], id_col: str = "doc_id") -> DataFrame:
    """Documents by part and by the filters they fail: part, mask, n, and n with each of ``marks``.

    ``found`` comes from :func:`failures`.  Bit ``copies`` of the mask is set where a smaller id stands with the
    same text anywhere.  Null ids are neither smaller than others nor copies.  An id has a mark
    if any of its rows in ``labels`` has; repeated rows of documents count each.
    Copies of one text are counted by their ids before they meet, so no task holds a group of them.
    """
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.lit(1).alias("labelled"), *(F.max(F.coalesce(mark, F.lit(False)).cast("int")).alias(name) for name, mark in marks.items()))
    none = [F.lit(0).alias(name) for name in marks]
    with_id = found.where(F.col("id").isNotNull()).join(known.hint("merge"), "id", "left")
    with_id = with_id.select("id", "fp", "part", "mask", "n", *(F.coalesce(name, F.lit(0)).alias(name) for name in marks))
    rows = with_id.unionByName(found.where(F.col("id").isNull()).select("id", "fp", "part", "mask", "n", *none))
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    groups = stored(rows.groupBy("fp", "part", "mask", *marks).agg(first, F.sum("n").alias("n"), nameless), "text-groups")
    smallest = groups.groupBy("fp").agg(F.min("first.id").alias("smallest"))
    original = F.when(F.col("first.id") == F.col("smallest"), F.col("first.n")).otherwise(0) + F.col("nameless")
    joined = groups.join(smallest.hint("merge"), "fp").withColumn("original", original)
    kinds = F.array(
        F.struct(F.col("mask"), F.col("original").alias("n")),
        F.struct((F.col("mask") + (1 << copies)).alias("mask"), (F.col("n") - F.col("original")).alias("n")),
    )
    both = joined.select("part", *marks, F.explode(kinds).alias("kind")).where(F.col("kind.n") > 0)
    counted = [F.sum("kind.n").alias("n"), *(F.sum(F.col("kind.n") * F.col(name)).alias(name) for name in marks)]
    return stored(both.groupBy("part", F.col("kind.mask").alias("mask")).agg(*counted), "failure-profile")


def edges(counted: DataFrame, filters: str, marks: list[str]) -> DataFrame:
    """What each edge of the lattice does in each part: part, state, filter, orders, kept, removed, redundant, unique_fails, and removed with each mark.

    orders is the number of orders that apply the filter in this state.  ``counted`` has at most one
    row for each part and set of filters, which is all that is repeated here.
    """
    forward, backward = path_counts(len(filters))
    every = [
        F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(letter).alias("filter"), F.lit(forward[s] * backward[s | 1 << f]).alias("orders"))
        for s in range(1 << len(filters))
        for f, letter in enumerate(filters)
        if not s >> f & 1
    ]
    rows = counted.select("part", "mask", "n", *marks, F.explode(F.array(*every)).alias("edge")).select("part", "mask", "n", *marks, "edge.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("state")) != 0
    total = lambda when, name, n="n": F.sum(F.when(when, F.col(n)).otherwise(0)).cast("bigint").alias(name)
    sums = [
        total(~fails & ~gone, "kept"),
        total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("mask") == F.col("bit"), "unique_fails"),
        *(total(fails & ~gone, f"{name}_lost", name) for name in marks),
    ]
    return rows.groupBy("part", "state", "filter", "orders").agg(*sums)


def audit(counted: DataFrame, filters: str, marks: list[str]) -> DataFrame:
    """One row for each part, order of ``filters`` (a letter each) and step in it, zeros included.

    part, filter_order, step (from 1), kept, removed, redundant (failing, removed before), unique_fails (failing this
    filter alone), a count of those removed for each mark, and shapley: what the step's filter removes in all orders
    together.  No parts, no rows.  More than ``MOST_FILTERS`` filters are an error.
    """
    if len(filters) > MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"one letter for each of at most {MOST_FILTERS} filters")
    found = stored(edges(counted, filters, marks), "lattice-edges")
    weighted = found.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).cast("bigint").alias("shapley"))
    place = {letter: i for i, letter in enumerate(filters)}
    steps = [
        ("".join(order), i + 1, reduce(or_, (1 << place[x] for x in order[:i]), 0), letter)
        for order in permutations(filters)
        for i, letter in enumerate(order)
    ]
    steps = counted.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter string")
    # as many steps as orders have, whatever the data
    read = found.join(F.broadcast(steps), ["state", "filter"]).join(weighted, ["part", "filter"])
    lost = [f"{name}_lost" for name in marks]
    return read.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *lost, "shapley")


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions on a text: few words, repeated words, capitals, marks.  A null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    n = F.size(words).cast("bigint")
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)).cast("bigint") * 100 < n * 50,
        "C": capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Audits the rules on texts (A to D) and E, being a copy of a document with a smaller id, for each language.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; other columns are not looked at.
    Null texts are empty, null languages the empty string, null ids have no label and are no copies.  Repeated
    rows count each; of rows with the smallest id of a text none is a copy.
    """
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    found = failures(docs, text_rules(F.col("text")))
    return audit(profile(found, labels, 4, marks), "ABCDE", list(marks))
