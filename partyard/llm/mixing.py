"""Mixing sources to target weights by min-cost flow over membership patterns.

A document may belong to several overlapping sources.  Documents are aggregated by
the set of sources they belong to; the flow runs from these patterns (a pass over a
pattern's words costs more each time it is repeated) to the sources' quotas.  What
the flow takes from a pattern is then drawn from its documents in a seeded order:
whole passes over all of them, and one partial pass over a seeded part.

Sources are numbered, weighed and filled in sorted tables, and a source that shares no
document needs no flow; the flow runs in tasks, one per set of connected sources.  The
driver sees one row per task of a sort, never the patterns.
Texts that are null or blank have size 0 and are never taken.  A null source is a
source of its own and comes last.  Rows with equal ids share their place in the
seeded order, so rerunning gives the same rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from partyard.llm.components import components
from partyard.session import stored

#: Cost of one word on its first, second, third pass: convex, so repeats come last.
PASS_COSTS = (0, 1, 3)
BIN_DIGITS = 3


def filled_targets(sizes: Sequence[int], weights: Sequence[int], most: int = 3) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its source's size.

    The excess over a cap goes to the other sources by weight, until none is above.
    """
    total, order = sum(sizes), sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    left, weight = total, sum(weights)
    targets = [0.0] * len(sizes)
    for place, i in enumerate(order):
        if left * weights[i] <= most * sizes[i] * weight:
            for j in order[place:]:
                targets[j] = left / weight * weights[j]
            break
        targets[i] = float(most * sizes[i])
        left, weight = left - most * sizes[i], weight - weights[i]
    return targets


def min_cost_flow(
    capacity: dict[int, int],
    members: dict[int, Sequence[int]],
    quotas: Sequence[int],
    costs: Sequence[int] = PASS_COSTS,
) -> dict[int, dict[int, int]]:
    """Words each pattern gives to each of its sources, at least repetition cost.

    Only passes cost anything, and what a pattern gives never falls when the flow is
    augmented (its words are at most handed to another source).  So the cheapest flow is
    reached by one maximal flow per pass in the order of the costs: all first passes,
    then all second ones on top of it.  Each is found in phases: a search from the
    patterns with words left gives every node its distance, then words are sent along
    ways on which it rises by one.  ``capacity`` holds the words of one pass.
    """
    flow: dict[int, dict[int, int]] = {p: dict.fromkeys(members[p], 0) for p in capacity}
    need = list(quotas)
    takers: dict[int, list[int]] = defaultdict(list)
    for p in capacity:
        for s in flow[p]:
            takers[s].append(p)
    left = dict.fromkeys(capacity, 0)
    for _ in sorted(costs):
        for p in capacity:
            left[p] += capacity[p]
        while _phase(flow, takers, left, need):
            pass
    return flow


def _phase(
    flow: dict[int, dict[int, int]], takers: dict[int, list[int]], left: dict[int, int], need: list[int]
) -> bool:
    """Send words along shortest ways until none is left; false if there was none."""
    far = {("p", p): 0 for p, n in left.items() if n > 0}
    edge, reached = list(far), False
    while edge and not reached:
        after = []
        for node in edge:
            kind, i = node
            nexts = (("s", s) for s in flow[i]) if kind == "p" else (("p", p) for p in takers[i] if flow[p][i] > 0)
            for n in nexts:
                if n not in far:
                    far[n] = far[node] + 1
                    after.append(n)
                    reached |= n[0] == "s" and need[n[1]] > 0
        edge = after
    if not reached:
        return False
    last = max(far.values())
    ways = {n: list(flow[n[1]]) if n[0] == "p" else takers[n[1]] for n in far}
    tried = dict.fromkeys(far, 0)
    for start in [p for p, n in left.items() if n > 0]:
        path = [("p", start)]
        while path and left[start] > 0:
            node = path[-1]
            kind, i = node
            if kind == "s" and far[node] == last and need[i] > 0:
                backs = [flow[b[1]][a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s"]
                amount = min([left[start], need[i], *backs])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                left[start] -= amount
                need[i] -= amount
                path = path[:1]
                continue
            other = "s" if kind == "p" else "p"
            while tried[node] < len(ways[node]):
                n = (other, ways[node][tried[node]])
                if far.get(n) == far[node] + 1 and (kind == "p" or flow[n[1]][i] > 0):
                    path.append(n)
                    break
                tried[node] += 1
            else:
                path.pop()
                if path:
                    tried[path[-1]] += 1
    return True


def seeded_place(keys: Sequence[str], seed: int) -> Column:
    """Hex digest that orders documents; its head is the histogram bin."""
    named = [F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]
    return F.md5(F.concat_ws(":", *named, F.lit(str(seed))))


def mix(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    seed: int = 17,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Words taken of every document.

    ``docs`` has ``doc_id`` (or other ``keys``), ``size`` (long) and ``sources`` (array
    of strings, null entries allowed).  ``targets`` maps sources to words; without it the sources share
    all words by the weights 1, 2, 3, repeating in code point order, and a document of
    several sources counts for each.  Returns the keys, sources,
    size, source_size and target (null for several sources), taken and passes.
    """
    kept = stored(
        docs.select(
            *keys,
            F.array_sort(F.array_distinct("sources")).alias("sources"),
            F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
            seeded_place(keys, seed).alias("place"),
        )
    )
    patterns = stored(kept.groupBy("sources").agg(F.sum("size").alias("words")))
    goals = _goals(patterns, targets)
    return _drawn(kept, _plan(patterns, goals), keys)


def _placed(df: DataFrame, *order: Column) -> DataFrame:
    """The rows stored in order, with their place in the sort (``at``) and its part (``part``)."""
    rows = stored(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
    return rows.withColumn("part", F.shiftright("at", 33))


def _before(rows: DataFrame, *names: str) -> DataFrame:
    """Add for each column its total over all rows that stand before.

    The parts of the sort, as many as it has tasks, are added up on the driver; inside a
    part the sum runs.
    """
    sums = {r["part"]: [r[n] for n in names] for r in rows.groupBy("part").agg(*(F.sum(n).alias(n) for n in names)).collect()}
    offsets, running = [], [0] * len(names)
    for part in sorted(sums):
        offsets.append((part, *running))
        running = [a + b for a, b in zip(running, sums[part], strict=True)]
    schema = ", ".join(["part long", *(f"__{n} long" for n in names)])
    table = F.broadcast(rows.sparkSession.createDataFrame(offsets, schema))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ahead = {f"before_{n}": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in names}
    summed = rows.withColumns(ahead).join(table, "part")
    return summed.withColumns({f"before_{n}": F.col(f"before_{n}") + F.col(f"__{n}") for n in names}).drop(
        *(f"__{n}" for n in names)
    )


def _goals(patterns: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """Every source: its number in code point order, its words, its target, and whether it shares documents."""
    most = len(PASS_COSTS)
    found = patterns.select((F.size("sources") > 1).alias("shared"), "words", F.explode("sources").alias("source"))
    sources = found.groupBy("source").agg(F.sum("words").alias("words"), F.max("shared").alias("shared"))
    numbered = _before(
        _placed(sources, F.col("source").asc_nulls_last()).withColumn("one", F.lit(1).cast("long")), "one"
    ).select("source", "words", "shared", F.col("before_one").alias("number"))
    if targets is not None:
        given = patterns.sparkSession.createDataFrame(
            [(s, float(n)) for s, n in targets.items()], "s string, g double"
        )
        wanted = F.least(F.coalesce("g", F.lit(0.0)), (most * F.col("words")).cast("double"))
        goals = numbered.join(given, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("target", wanted)
    else:
        weight = F.col("number") % 3 + 1
        ratio = (most * F.col("words")).cast("double") / F.col("weight")
        rows = _before(_placed(numbered.withColumn("weight", weight), ratio, F.col("number")), "words", "weight")
        total, shares = rows.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        remaining = F.lit(total) - most * F.col("before_words")
        left = F.lit(shares) - F.col("before_weight")
        exact = [c.cast("decimal(19,0)") for c in (remaining, F.col("weight"), most * F.col("words"), left)]
        # The first source that a fair share of what the ones before leave does not fill.
        first = (
            rows.filter(exact[0] * exact[1] <= exact[2] * exact[3])
            .agg(F.min(F.struct("at", remaining.alias("remaining"), left.alias("shares"))).alias("first"))
            .first()["first"]
        )
        full = (most * F.col("words")).cast("double")
        target = full
        if first is not None:
            level = first["remaining"] / first["shares"]
            target = F.when(F.col("at") < first["at"], full).otherwise(F.lit(level) * F.col("weight"))
        goals = rows.withColumn("target", target)
    return stored(
        goals.select("source", "number", "words", "shared", "target", F.floor("target").cast("long").alias("want"))
    )


def _plan(patterns: DataFrame, goals: DataFrame) -> DataFrame:
    """Whole passes and the words of a partial one for every pattern.

    A source that shares no document has one pattern and takes its own words as often as
    its target asks: no flow is needed.  The flow runs over each set of sources that
    shared documents connect, where its rows lie; a connected set is one group, however
    many sets there are.
    """
    words = F.col("words")

    passes = [
        F.when(words > 0, F.expr("taken div words")).otherwise(0).cast("long").alias("passes"),
        F.when(words > 0, F.col("taken") % words).otherwise(0).cast("long").alias("rest"),
    ]
    alone = patterns.filter(F.size("sources") == 1).select("sources", "words", F.col("sources")[0].alias("__source"))
    facts = goals.select(
        F.col("source").alias("__key"), F.col("words").alias("source_size"), "target", "want", "shared", "number"
    )
    single = alone.join(facts, F.col("__source").eqNullSafe(F.col("__key")))
    lone = single.filter(~F.col("shared")).withColumn("taken", F.col("want"))
    plan = lone.select("sources", *passes, "source_size", "target")
    none = patterns.filter(F.coalesce(F.size("sources"), F.lit(-1)) < 1)
    nothing = [F.lit(0).cast("long").alias(n) for n in ("passes", "rest")]
    plan = plan.unionByName(
        none.select("sources", *nothing, F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"))
    )
    if goals.filter("shared").isEmpty():
        return plan
    taken = _flow_taken(patterns, goals)
    several = taken.join(
        single.select(F.col("sources").alias("__own"), "source_size", "target"),
        F.col("sources").eqNullSafe(F.col("__own")),
        "left",
    )
    return plan.unionByName(several.select("sources", *passes, "source_size", "target"))


def _flow_taken(patterns: DataFrame, goals: DataFrame) -> DataFrame:
    """Words taken from every pattern whose sources share documents."""
    shared = goals.filter("shared").select(F.col("source").alias("__key"), "number", "want")
    members = (
        patterns.filter(F.size("sources") > 0)
        .select("sources", "words", F.explode("sources").alias("__source"))
        .join(shared, F.col("__source").eqNullSafe(F.col("__key")))
        .groupBy("sources", "words")
        .agg(F.array_sort(F.collect_list(F.struct("number", "want"))).alias("members"))
    )
    members = stored(members)
    first = F.col("members")[0]["number"]
    links = members.filter(F.size("members") > 1).select(
        first.alias("a"), F.explode(F.transform(F.slice("members", 2, 1 << 30), lambda m: m["number"])).alias("b")
    )
    groups = components(links).withColumnRenamed("node", "__node")
    rows = members.join(groups, first == F.col("__node")).select("component", "sources", "words", "members")
    schema = to_arrow_schema(T._parse_datatype_string(_TAKEN), prefers_large_types=False)

    def run(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: [m["number"] for m in r["members"]])
        want = {m["number"]: m["want"] for r in found for m in r["members"]}
        at = {number: k for k, number in enumerate(sorted(want))}
        flow = min_cost_flow(
            {k: r["words"] for k, r in enumerate(found)},
            {k: [at[m["number"]] for m in r["members"]] for k, r in enumerate(found)},
            [want[number] for number in sorted(want)],
        )
        return pa.Table.from_pylist(
            [{"sources": r["sources"], "words": r["words"], "taken": sum(flow[k].values())} for k, r in enumerate(found)],
            schema,
        )

    return rows.groupBy("component").applyInArrow(run, _TAKEN)


_TAKEN = "sources array<string>, words long, taken long"


def _drawn(kept: DataFrame, plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Draw each pattern's partial pass in the seeded order.

    The words are counted per bin of the order; only the bin in which the partial pass
    ends is ordered row by row, so no task sorts a whole source.
    """
    planned = kept.withColumn("bin", F.substring("place", 1, BIN_DIGITS))
    bins = planned.groupBy("sources", "bin").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("sources").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        bins.join(plan, bins["sources"].eqNullSafe(plan["sources"]))
        .drop(plan["sources"])
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .withColumn(
            "state",
            F.when(F.col("before") + F.col("words") <= F.col("rest"), F.lit(1))
            .when(F.col("before") < F.col("rest"), F.lit(0))
            .otherwise(F.lit(-1)),
        )
        .withColumnsRenamed({"sources": "b_sources", "bin": "b_bin"})
    )
    rows = planned.join(
        bins, F.col("sources").eqNullSafe(F.col("b_sources")) & (F.col("bin") == F.col("b_bin"))
    ).drop("b_sources", "b_bin", "words")
    inside = Window.partitionBy("sources", "bin").orderBy("place", *keys, "size")
    earlier = F.coalesce(
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    edge = (
        rows.filter("state = 0")
        .withColumn("extra", 2 * (F.col("before") + earlier) + F.col("size") <= 2 * F.col("rest"))
    )
    other = rows.filter("state <> 0").withColumn("extra", F.col("state") == 1)
    whole = other.unionByName(edge)
    passes = F.when(F.col("size") > 0, F.col("passes") + F.col("extra").cast("long")).otherwise(0)
    return whole.select(
        *keys,
        "sources",
        "size",
        "source_size",
        "target",
        (F.col("size") * passes).alias("taken"),
        passes.alias("passes"),
    )
