"""Tool calls: what a model wrote, read as calls, and made calls held against required ones.

A call is (tool, args) with its arguments as a JSON text. Calls are compared by
their canonical arguments, a list of (key, text) in order of key.
"""

from __future__ import annotations

import ast
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from traceloom.functions import leaves
from traceloom.functions.scalar import let
from traceloom.session import cut

PARTS, CALLS = (ArrayType(StructType([StructField(n, StringType()) for n in names])) for names in (("key", "text"), ("tool", "args")))
PARSED = StructType([StructField("calls", CALLS), StructField("malformed", BooleanType())])


# Canonical arguments


def closed_aliases(text: Column, key: Column, classes: dict[str, list[tuple[str, str]]]) -> Column:
    """A top-level argument's canonical text with whole-value aliases of its key replaced: pattern to name, ``$1`` allowed.

    Only strings have aliases; a pattern must match the whole of one.
    """
    out = text
    for name, pairs in classes.items():
        for pattern, by in reversed(pairs):
            whole = f"^string:(?:{pattern})$"
            out = F.when((key == name) & text.rlike(whole), F.regexp_replace(text, whole, f"string:{by}")).otherwise(out)
    return out


@F.pandas_udf(PARTS)
def argument_parts(args: pd.Series) -> pd.Series:
    """Top-level arguments of a JSON object, in order of key, as type and text; null where the text is no JSON object."""

    def text(v) -> str:
        kind, shown = leaves.scalar_leaf(v) if not isinstance(v, (dict, list)) else ("parts", json.dumps(sorted(leaves.leaves(v).items()), ensure_ascii=False))
        return f"{kind}:{'' if shown is None else shown}"

    def of(a):
        try:
            v = leaves.read_json(a)
        except ValueError:
            return None
        return [{"key": k, "text": text(v[k])} for k in sorted(v)] if isinstance(v, dict) else None

    return args.map(of)


def canonical(calls: DataFrame, key: list[str], classes: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(key, pos, run, tool, args, parts, sign) of calls (key, pos, round, tool, args).

    ``run`` numbers the runs of one round number along ``pos``: a number that
    comes back later is another round. ``sign`` is equal for equal calls; null
    ``args`` and those that are no JSON object have null ``parts`` and equal
    nothing.
    """
    along = Window.partitionBy(*key).orderBy("pos")
    new = F.coalesce((~F.col("round").eqNullSafe(F.lag("round").over(along))) | (F.row_number().over(along) == 1), F.lit(True))
    read = calls.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    read = read.withColumn("parts", argument_parts("args"))
    if classes:
        read = read.withColumn("parts", F.transform("parts", lambda p: F.struct(p["key"].alias("key"), closed_aliases(p["text"], p["key"], classes).alias("text"))))
    return read.select(*key, "pos", F.col("run").cast("long").alias("run"), "tool", "args", "parts", F.concat(F.to_json(F.array("tool")), F.to_json("parts")).alias("sign"))


# Comparison


def pairing(want: np.ndarray, made: np.ndarray) -> np.ndarray:
    """For each wanted sign the place of its partner in a longest common subsequence, else -1; -1 in ``made`` equals nothing.

    Row i of the table holds, for each start, the longest common subsequence of
    what is left; a row is the running maximum, from the end, of the row below
    and of it moved by one where the signs are equal. Of several subsequences
    the one that gives up earlier wanted calls first counts.
    """
    n, m = len(want), len(made)
    equal = want[:, None] == made
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        below = table[i + 1]
        step = np.maximum(below[:-1], (below[1:] + 1) * equal[i])
        table[i, :-1] = np.maximum.accumulate(step[::-1])[::-1]
    out, j = np.full(n, -1), 0
    for i in range(n):
        stops = equal[i, j:] | (table[i + 1, j:-1] >= table[i, j + 1 :])  # a partner, or none is worth going on for
        if not stops.any():
            break
        j += int(stops.argmax())
        if equal[i, j]:
            out[i], j = j, j + 1
    return out


@F.pandas_udf(ArrayType(IntegerType()))
def partners(want: pd.Series, made: pd.Series, want_tools: pd.Series, made_tools: pd.Series) -> pd.Series:
    """Of each wanted call the place j of its partner by ``pairing``, or -2 - j of its tool's next unused call, or -1; then the places left over.

    Series are arrays of signs and of tools. A null array is empty, a null sign
    equals nothing, and a call without a tool meets no unused one.
    """

    def of(a, b, a_tools, b_tools):
        a, b, a_tools, b_tools = ([] if x is None else list(x) for x in (a, b, a_tools, b_tools))
        kinds = {s: i for i, s in enumerate(dict.fromkeys(s for s in a if s is not None))}
        to = pairing(np.array([kinds.get(s, -2) for s in a], np.int64), np.array([kinds.get(s, -1) for s in b], np.int64)).tolist()
        taken, unused = set(to), {}
        for j, tool in enumerate(b_tools):
            if j not in taken:
                unused.setdefault(tool, []).append(j)
        left = {tool: iter(places) for tool, places in unused.items() if tool is not None}
        out = [j if j >= 0 else -2 - next(left.get(tool, iter(())), -1) for j, tool in zip(to, a_tools)]
        met = {-2 - j for j in out if j < -1}
        return out + [j for places in unused.values() for j in places if j not in met]

    return pd.Series([of(*row) for row in zip(want, made, want_tools, made_tools)], dtype=object)


def _with_objects(required: DataFrame) -> DataFrame:
    """Required calls whose arguments are no JSON object ask for none."""
    return required.withColumn("args", F.when(F.get_json_object("args", "$").startswith("{"), F.col("args")).otherwise("{}"))


def compared(required: DataFrame, made: DataFrame, key: list[str], classes: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(key, want, made, to, structure): both sides' calls of every segment, ``partners``, and whether they have the same rounds.

    Both sides are calls (key, pos, round, tool, args), each read once; ``key``
    names a segment, whose calls must fit in a row. Required arguments that are
    no JSON object count as {}. ``structure``: the same rounds, as runs, of the
    same number of equal calls, place by place.
    """
    row = lambda df: canonical(df, key, classes).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "tool", "args", "parts", "sign", "run"))).alias("calls"))
    both = row(_with_objects(required)).withColumnRenamed("calls", "want").join(row(made).withColumnRenamed("calls", "made"), key, "full")
    shape = lambda c: F.transform(c, lambda x: F.struct(x["run"].alias("run"), x["sign"].alias("sign")))
    both = both.withColumn("structure", F.coalesce(shape("want") == shape("made"), F.lit(False)))
    return both.select(*key, "want", "made", partners("want.sign", "made.sign", "want.tool", "made.tool").alias("to"), "structure")


def details_of(segments: DataFrame, key: list[str]) -> DataFrame:
    """``call_details`` of ``compared`` segments, each from its own row.

    Of an inner explode Spark derives a filter that compares the calls again.
    """
    n = F.when(F.col("want").isNull(), 0).otherwise(F.size("want"))
    each = segments.select(*key, "want", "made", n.alias("n"), F.posexplode_outer("to").alias("i", "j"))
    place = F.when((F.col("i") >= F.col("n")) | (F.col("j") >= 0), F.col("j")).when(F.col("j") < -1, -2 - F.col("j"))
    each = each.select(*key, F.get("want", F.col("i")).alias("w"), F.get("made", place).alias("m"), ((F.col("i") < F.col("n")) & (F.col("j") >= 0)).alias("paired"))
    text = lambda parts, k: f"get(filter({parts}, p -> p.key = {k}), 0).text"
    differing = F.expr(f"array_min(filter(array_union(w.parts.key, m.parts.key), k -> NOT ({text('w.parts', 'k')} <=> {text('m.parts', 'k')})))")
    why = F.when(F.col("m.parts").isNull(), "unparseable_args").otherwise(F.coalesce(F.concat(F.lit("wrong_args:"), differing), F.lit("out_of_order")))
    why = F.when(F.col("paired"), "correct").when(F.col("w").isNull(), "extra_call").when(F.col("m").isNull(), "missing").otherwise(why)
    return each.select(*key, F.col("w.pos").alias("required_pos"), F.col("m.pos").alias("made_pos"), F.coalesce("w.tool", "m.tool").alias("tool"), F.col("w.args").alias("required_args"), F.col("m.args").alias("made_args"), why.alias("reason"))


def scores_of(segments: DataFrame, key: list[str]) -> DataFrame:
    """``segment_scores`` of ``compared`` segments, each from its own row."""
    known = segments.where(" AND ".join(f"{k} IS NOT NULL" for k in key))
    n = F.when(F.col("want").isNull(), 0).otherwise(F.size("want")).cast("long")
    correct = F.size(F.filter("to", lambda j, i: (j >= 0) & (i < F.col("n")))).cast("long")
    return known.withColumn("n", n).select(*key, F.col("n").alias("required"), correct.alias("correct"), (F.size("to") - F.col("n")).alias("extra"), "structure")


def call_details(required: DataFrame, made: DataFrame, key: list[str], classes: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(key, required_pos, made_pos, tool, required_args, made_args, reason): a row for every required call and every extra one.

    Sides as in ``compared``. Reasons: ``correct``; of a required call without a
    partner that meets the first unused call of its tool, ``unparseable_args``,
    ``wrong_args:<first differing key>`` or ``out_of_order``; ``missing``
    without such a call; ``extra_call`` for calls left over.
    """
    return details_of(compared(required, made, key, classes), key)


def segment_scores(details: DataFrame, required: DataFrame, made: DataFrame, key: list[str], classes: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(key, required, correct, extra, structure) of every segment of either side, counted from its ``details``.

    ``scores_of`` gives the same without a second reading of the calls.
    """
    n = details.groupBy(*key).agg(F.count("required_pos").alias("required"), F.count_if(F.col("reason") == "correct").alias("correct"), F.count_if(F.col("reason") == "extra_call").alias("extra"))
    return compared(required, made, key, classes).select(*key, "structure").join(n, key).select(*key, "required", "correct", "extra", "structure")


def task_scores(segments: DataFrame, tasks: DataFrame, task: str) -> DataFrame:
    """(tasks' columns, required, correct, extra, matched): segments added up by task.

    ``tasks`` has a row a task, with ``complete`` and ``error``; a task matches
    if all its segments have the right structure, it is complete and no error
    stopped it. A task without calls on either side has none and may match.
    """
    sums = segments.groupBy(task).agg(F.sum("required").alias("required"), F.sum("correct").alias("correct"), F.sum("extra").alias("extra"), F.bool_and("structure").alias("whole"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    matched = F.coalesce("whole", F.lit(True)) & F.coalesce("complete", F.lit(False)) & F.col("error").isNull()
    return tasks.join(sums, task, "left").select(*tasks.columns, zero("required"), zero("correct"), zero("extra"), matched.alias("matched"))


def summary(scores: DataFrame, slices: dict[str, Column], task: str) -> DataFrame:
    """One row a slice and value, and one for all: rates, latencies, tokens and costs of ``task_scores``.

    Rates have four places, 1.0 for calls where nothing is required; costs six;
    latencies are nearest ranks to one place, null without one. ``least_task``
    and ``most_task`` locate the slice's tasks. ``scores`` has cost, latency,
    tokens_in and tokens_out besides. Tasks are numbered along latency in
    ranges, so no task holds a slice.
    """
    from traceloom.operators.ranks import running

    scores = cut(scores)  # sums and ranks read them
    every = F.explode(F.array(F.struct(F.lit("overall").alias("slice"), F.lit("all").alias("value")), *[F.struct(F.lit(k).alias("slice"), c.cast("string").alias("value")) for k, c in slices.items()]))
    long = scores.withColumn("s", every).select("s.slice", F.coalesce("s.value", F.lit("")).alias("value"), task, "required", "correct", "extra", "matched", "error", "cost", "latency", "tokens_in", "tokens_out")
    rate = F.coalesce(F.when(F.sum("required") > 0, F.round(F.sum("correct") / F.sum("required"), 4)), F.lit(1.0))
    sums = long.groupBy("slice", "value").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("matched").cast("int")), 4).alias("trace_match"), rate.alias("call_match"), F.sum("required").alias("required"), F.sum("correct").alias("correct"), F.sum("extra").alias("extra"),
        F.count("error").alias("errors"), F.count("latency").alias("latencies"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"),
        F.round(F.sum("cost"), 6).alias("cost"), F.round(F.sum("cost") / F.count("*"), 6).alias("cost_a_task"), F.min(task).alias("least_task"), F.max(task).alias("most_task"))
    ranked = running(long.where("latency IS NOT NULL").withColumn("one", F.lit(1)), ["slice", "value"], ["latency", task], "one")
    at = lambda q: F.max(F.when(F.col("upto") == F.greatest(F.lit(1), F.ceil(F.col("total") * q)), F.round("latency", 1)))
    ranks = ranked.groupBy("slice", "value").agg(at(0.5).alias("p50"), at(0.95).alias("p95"))
    return sums.join(ranks, ["slice", "value"], "left")


# Parsers


def tagged_calls(text: Column) -> Column:
    """Struct (calls, malformed) of ``<tool_call><function=f><parameter=p>v</parameter></function></tool_call>`` blocks; null text has none.

    Column functions alone: blocks are cut out, and in each the function and its
    parameters. Malformed: a tag of a call outside whole blocks, a block of
    other than one function, text beside a block's function or a function's
    parameters, and a parameter given twice.
    """
    block, function, parameter = r"(?s)<tool_call>(.*?)</tool_call>", r"(?s)<function=([^>\s]+)>(.*?)</function>", r"(?s)<parameter=([^>\s]+)>\n?(.*?)\n?</parameter>"
    every = lambda c, pattern, i: F.regexp_extract_all(c, F.lit(pattern), F.lit(i))
    beside = lambda c, pattern: F.regexp_replace(F.regexp_replace(c, pattern, ""), r"\s+", "") != ""

    def call(name: Column, body: Column) -> Column:
        def given(p: Column) -> Column:
            names, values = p["k"], p["v"]
            last = F.filter(F.arrays_zip(names.alias("k"), values.alias("v")), lambda x, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), x["k"]))
            args = F.coalesce(F.to_json(F.map_from_entries(last)), F.lit("{}"))
            twice = F.size(F.array_distinct(names)) < F.size(names)
            return F.struct(name.alias("tool"), args.alias("args"), (twice | beside(body, parameter)).alias("bad"))

        return let(F.struct(every(body, parameter, 1).alias("k"), every(body, parameter, 2).alias("v")), given)

    def calls_of(inside: Column) -> Column:
        def own(f: Column) -> Column:
            calls = F.zip_with(f["names"], f["bodies"], call)
            return F.struct(calls.alias("calls"), ((F.size(f["names"]) != 1) | beside(inside, function)).alias("bad"))

        return let(F.struct(every(inside, function, 1).alias("names"), every(inside, function, 2).alias("bodies")), own)

    def whole(read: Column) -> Column:
        calls, blocks = F.flatten(F.transform(read["blocks"], lambda b: b["calls"])), read["blocks"]
        bad = (F.regexp_count(read["text"], F.lit(r"<\s*/?\s*tool_call")) != 2 * F.size(blocks)) | F.exists(blocks, lambda b: b["bad"])
        return let(calls, lambda c: F.struct(F.transform(c, lambda x: F.struct(x["tool"].alias("tool"), x["args"].alias("args"))).alias("calls"), (bad | F.exists(c, lambda x: x["bad"])).alias("malformed")))

    known = let(F.coalesce(text, F.lit("")), lambda t: F.struct(t.alias("text"), F.transform(every(t, block, 1), calls_of).alias("blocks")))
    return let(known, whole)


def _literal_call(node: ast.expr) -> dict:
    """A call of a plain name with distinct named literals; ValueError for anything else."""
    if not isinstance(node, ast.Call) or not isinstance(node.func, ast.Name) or node.args:
        raise ValueError("no call of named arguments")
    given = {k.arg: ast.literal_eval(k.value) for k in node.keywords}
    if None in given or len(given) < len(node.keywords):
        raise ValueError("an argument without a name, or one twice")
    return {"tool": node.func.id, "args": json.dumps(given, ensure_ascii=False)}


def bracketed_calls(opening: str = "<|tool_call_start|>", closing: str = "<|tool_call_end|>"):
    """A pandas UDF, text to (calls, malformed), of one ``[f(a=1), g()]`` between markers: literals only, read as syntax and never run."""
    thought = re.compile(r"<think>.*?</think>", re.S | re.I)
    marked = re.compile(re.escape(opening) + "|" + re.escape(closing))

    def of(text: str | None) -> tuple[list[dict], bool]:
        text = thought.sub("", text or "")
        marks, parts = marked.findall(text), marked.split(text)
        if not marks:
            return [], False
        if marks != [opening, closing]:
            return [], True
        try:
            tree = ast.parse(parts[1].strip(), mode="eval").body
            calls = list(map(_literal_call, tree.elts if isinstance(tree, (ast.List, ast.Tuple)) else [tree]))
        except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
            return [], True
        return calls, not calls or bool(parts[0].strip() or parts[2].strip())

    @F.pandas_udf(PARSED)
    def parse(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([of(t) for t in texts], columns=["calls", "malformed"])

    return parse


def emission_reward(w_call: float = 0.8, w_struct: float = 0.2, w_extra: float = 0.1, w_format: float = 0.3, low: float = 0.0, high: float = 1.0):
    """A pandas UDF of required calls, made calls and whether these are malformed: calls are held against each other place by place; silence is right where none is required."""

    def right(want, made) -> bool:
        try:
            return want["tool"] == made["tool"] and leaves.same(leaves.read_json(want["args"]), leaves.read_json(made["args"]))
        except ValueError:
            return False

    @F.pandas_udf("double")
    def reward(required: pd.Series, calls: pd.Series, malformed: pd.Series) -> pd.Series:
        want, made = (c.map(lambda x: [] if x is None else list(x)) for c in (required, calls))
        n, m, bad = want.map(len), made.map(len), malformed.fillna(False).astype(bool)
        hits = pd.Series([sum(map(right, a, b)) for a, b in zip(want, made)], index=n.index, dtype="int64")
        silent = ((m == 0) & ~bad).astype(float)
        share = (hits / n.where(n > 0, 1)).where(n > 0, silent)
        whole = ~bad & (n == m) & (n == hits)
        return (w_call * share + w_struct * whole - w_extra * (m - n).clip(lower=0) - w_format * bad).clip(low, high).astype("float64")

    return reward
