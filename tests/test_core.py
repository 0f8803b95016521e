"""Queries against SQL, and the parts that SQL cannot express against plain Python."""

import itertools
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import compare
from traceloom.functions import dialogue, leaves, scalar
from traceloom.operators import differences, evaluation, flows, graph, hybrid, ranks, records, retrieval, sampling, schemas, scoring, selection, text_rules, worlds
from traceloom.operators.graph import connected_components
from traceloom.plans import contracts
from traceloom.plans.catalog import ORACLES, QUERIES
from traceloom.session import table
from traceloom.sources import files
from traceloom.sources import lines as lines_of
from traceloom.sources.keyed import KeyedTable
from traceloom.streaming import capped, episodes


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, small, name):
    assert compare.difference(QUERIES[name](spark, small), compare.duck(small), ORACLES[name]) == ""


def test_blocks_that_a_task_holds_do_not_grow_with_the_vectors(spark):
    vectors = spark.range(0, 2000, 1, 2).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float")).alias("embedding"))
    for n in (500, 2000):
        cells = retrieval.block_cells(vectors.where(f"vec_id < {n}"), F.col("vec_id") % 5 == 0, block=5)
        held = [r["count"] for r in cells.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == (n // 5) * (n // 25) and max(held) <= 100


def test_audits_hold_little_in_a_task(spark, small):
    """Replays are counted by their results themselves, and a schedule is made once for all rules."""
    plan = lambda name: str(QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan())
    assert "sha2(" not in plan("replay_determinism")
    assert "Window" not in plan("schedule_audit")


def test_schedule_audit_counts_what_is_missing_or_repeated(spark):
    source = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, None)], "i int")
    schedule = spark.createDataFrame([("g", 1, 0), ("g", 1, 0), ("g", 1, 1), ("g", 2, 1), ("g", None, 2), ("g", 9, 2)], "g string, i int, batch int")
    got = {r.rule: (r.bad, r.status) for r in worlds.schedule_audit(schedule, source, "g", "i", 2, 2).collect()}
    assert got == {"covers the sources": (2, "FAIL"), "occurrences": (1, "FAIL"), "full batches": (2, "FAIL")}


def test_versions_are_taken_apart_once(spark, small):
    """Four readings of leaves, of two sides' columns and JSON; the versions themselves are not read again."""
    plan = str(QUERIES["version_audit"](spark, small)._jdf.queryExecution().optimizedPlan())
    assert plan.count("json_leaves(") == 4 and "parquet" not in plan


@pytest.mark.parametrize("name", ["route_enumeration", "reachability"])
def test_walks_do_not_count_edges_again(spark, small, name):
    """Joins with the edges read them as written, not the tables they were counted from."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    reads, real = [], flows.cut
    flows_cut = lambda df: reads.append(df.columns) or real(df)
    flows.cut = flows_cut
    try:
        QUERIES[name](spark, small)
    finally:
        flows.cut = real
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert reads == [["edge_id", "a", "b"]]


def test_vector_topk_answers_every_query(spark, small):
    ids = [r.vec_id for r in table(spark, small, "embeddings").select("vec_id").collect()]
    got = defaultdict(int)
    for r in QUERIES["vector_topk_whole"](spark, small).collect():
        got[r.query_id] += 1
    assert got == {i: min(10, len(ids) - 1) for i in ids if i % 20 == 0}


def test_route_catalog_tells_routes_with_one_beginning_apart(spark, small):
    want = defaultdict(list)
    for user, days in _by_user(spark, small).items():
        want[">".join(a for d in sorted(days) for a in days[d])].append(user)
    got = {r.route: (r.n_users, r.least_user) for r in QUERIES["route_catalog_whole"](spark, small).collect()}
    assert got == {route: (len(users), min(users)) for route, users in want.items()}
    assert max(route.count(">") for route in got) > 3


def test_entry_imports_without_the_optional_folders(tmp_path):
    """In a copy without the subpackage and the pipeline, the other queries are still there."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "traceloom", tmp_path / "traceloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]
    (tmp_path / "traceloom" / "llm").mkdir()
    (tmp_path / "traceloom" / "llm" / "queries.py").write_text("import no_such_module\n")
    again = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=True)
    assert again.stdout == out.stdout


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def _by_user(spark, small):
    days = defaultdict(lambda: defaultdict(list))
    for r in table(spark, small, "events").orderBy("ts", "event_id").collect():
        days[r.user_id][r.ts.date()].append(r.event_type)
    return days


def test_lcs_score(spark, small):
    got = {r.user_id: (r.required, r.made, r.matched) for r in QUERIES["lcs_score"](spark, small).collect()}
    for user, days in _by_user(spark, small).items():
        golden, made = days[min(days)], days[max(days)]
        assert got[user] == (len(golden), len(made), _lcs(golden, made))


def _machine(actions):
    at, bad, n = "new", 0, 0
    for a in actions:
        if n >= episodes.STEP_CAP or at == "done":
            break
        at, ok = episodes.advance(at, a)
        bad, n = bad + (not ok), n + 1
    return at, bad, n


def test_episode_replay_batch_and_stream(spark, small, tmp_path):
    want = {u: _machine([a for d in sorted(days) for a in days[d]]) for u, days in _by_user(spark, small).items()}
    assert {r.user_id: (r.state, r.violations, r.steps) for r in QUERIES["episode_replay"](spark, small).collect()} == want
    events = table(spark, small, "events")
    for k in range(2):  # two files in order of time, one batch each
        events.where(f"ts {'<' if k == 0 else '>='} (SELECT percentile_approx(ts, 0.5) FROM parquet.`{small}/events.parquet`)").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    seen = {}

    def keep(batch, _):
        seen.update({r.user_id: (r.state, r.violations, r.steps) for r in batch.collect()})

    q = episodes.stream_replay(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1200)}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\nbad\n{"k": 2}\n')
    assert files.read_records(spark, str(tmp_path / "a.jsonl"), schema="k long", strict=False).count() == 2
    with pytest.raises(Exception):
        files.read_records(spark, str(tmp_path / "a.jsonl"), schema="k long").collect()
    folder = tmp_path / "n"
    folder.mkdir()
    for i in (2, 10):
        (folder / f"{i}.json").write_text(json.dumps({"k": i}))
    (folder / "x.json").write_text('{"k": 0}')
    assert sorted((r.file_id, r.k) for r in files.read_numbered(spark, str(folder), "k long").collect()) == [(2, 2), (10, 10)]
    manifest = spark.createDataFrame([("2.json", "00"), ("gone.json", "00")], "name string, sha256 string")
    assert {r.name: r.status for r in files.sealed(spark, str(folder), manifest).collect()} == {"2.json": "changed", "gone.json": "missing", "10.json": "extra", "x.json": "extra"}
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert files.append_new(one, str(tmp_path / "t"), "id") == 2 and files.append_new(one, str(tmp_path / "t"), "id") == 0
    with pytest.raises(ValueError):
        files.append_new(spark.createDataFrame([(2, "c")], one.schema), str(tmp_path / "t"), "id")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    with pytest.raises(ValueError):
        files.append_new(spark.createDataFrame([(7, "a"), (7, "b")], one.schema), str(tmp_path / "t"), "id")
    assert files.append_new(spark.createDataFrame([(7, "a"), (7, "a"), (1, "a")], one.schema), str(tmp_path / "t"), "id") == 1
    with pytest.raises(ValueError):
        files.append_new(spark.createDataFrame([(1, "a"), (1, "b")], one.schema), str(tmp_path / "fresh"), "id")
    assert not (tmp_path / "fresh").exists()


def test_one_row_a_run_on_the_board(spark):
    board = spark.createDataFrame([(1, "r", 5), (2, "s", 6)], "id int, run string, score int")
    runs = spark.createDataFrame([(1, "r", 8), (2, "r", 7), (1, "n", 1), (3, "n", 2), (2, "m", 3)], "at int, run string, score int")
    got = lambda order: sorted((r.id, r.run, r.score) for r in evaluation.upsert(board, runs, "run", "score", order).collect())
    assert got("at") == [(1, "r", 7), (2, "s", 6), (3, "m", 3), (4, "n", 2)] and got(None)[0] == (1, "r", 8)


def test_names_of_any_script_are_found(spark):
    """Random names and texts against a plain search by the rule in the docstring."""
    import re

    r = random.Random(9)
    parts = ["北京", "京", "a", "ab", "b", "é", "Ü", " ", "-", "'s ", "_", "#1", "旅行", "П", "\n", "!", "𝒳"]
    make = lambda n: "".join(r.choice(parts) for _ in range(r.randrange(1, n)))
    names = sorted({make(4) for _ in range(60)} | {"北京", "'s-Hertogenbosch"})
    texts = [make(14) for _ in range(200)] + ["去北京旅行", "in 's-hertogenbosch.", "", None]
    plain = lambda t: re.sub(r"[\x00-\x22\x24-\x2F\x3A-\x5E\x60\x7B-\x7F]+", " ", t.lower())
    word = "abcdefghijklmnopqrstuvwxyz0123456789_#"

    def holds(t, name):
        t, name = f" {plain(t)} ", plain(name).strip()
        at = [i for i in range(len(t)) if name and t.startswith(name, i)]
        return any(not (name[0] in word and t[i - 1] in word) and not (name[-1] in word and t[i + len(name)] in word) for i in at)

    want = {(i, n) for i, t in enumerate(texts) for n in names if t and holds(t, n)}
    rows, known = spark.createDataFrame(list(enumerate(texts)), "i int, t string"), spark.createDataFrame([(n,) for n in names], "n string")
    for most in (200_000, 20):
        got = [(x.i, x.name) for x in records.contained(rows, "t", known, "n", most).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert {"去北京旅行", "in 's-hertogenbosch."} <= {texts[i] for i, n in want if n in ("北京", "'s-Hertogenbosch")}


def _call(tool, args, round=1):
    return {"tool": tool, "args": args, "round": round}


CALLS = "seg int, pos int, round int, tool string, args string"


def _compared(spark, segments):
    """(correct, extra, structure, reasons in order of required call, extras last) of each pair of call lists."""
    rows = lambda side: spark.createDataFrame([(i, p, c["round"], c["tool"], c["args"]) for i, pair in enumerate(segments) for p, c in enumerate(pair[side])], CALLS)
    want, made = rows(0), rows(1)
    details = scoring.call_details(want, made, ["seg"])
    scores = {r.seg: r for r in scoring.segment_scores(details, want, made, ["seg"]).collect()}
    reasons = defaultdict(list)
    for r in sorted(details.collect(), key=lambda r: (r.required_pos is None, r.required_pos or 0)):
        reasons[r.seg].append(r.reason)
    return [(scores[i].correct, scores[i].extra, scores[i].structure, reasons[i]) if i in scores else None for i in range(len(segments))]


def test_segments_are_compared(spark):
    a, b, c = _call("find", '{"x": 1}'), _call("find", '{"x": 2}', 2), _call("book", '{"n": true}', 2)
    got = _compared(spark, [
        ([a, b, c], [a, b, c]), ([a, b, c], [a, {**b, "round": 1}, c]), ([a, b], [b, a]), ([c], [_call("book", '{"n": 1}')]), ([a], [_call("find", '{"x": 1.0}')]),
        ([a], [_call("find", "[1]")]), ([a], [_call("find", None)]), ([a], []), ([], [a]), ([], []), ([a], [_call("find", '{"x": [1, {"y": 2.0}]}')]), ([_call("f", "oops")], [_call("f", "{}")])])
    assert got[:3] == [(3, 0, True, ["correct"] * 3), (3, 0, False, ["correct"] * 3), (1, 0, False, ["out_of_order", "correct"])]
    assert got[3:7] == [(0, 0, False, ["wrong_args:n"]), (1, 0, True, ["correct"]), (0, 0, False, ["unparseable_args"]), (0, 0, False, ["unparseable_args"])]
    assert got[7:] == [(0, 0, False, ["missing"]), (0, 1, False, ["extra_call"]), None, (0, 0, False, ["wrong_args:x"]), (1, 0, True, ["correct"])]


def _plain_comparison(want, made):
    """By definition: the longest common subsequence by trying all, then each open call the first unused one of its tool."""
    from functools import cache

    @cache
    def best(i, j):
        if i == len(want) or j == len(made):
            return 0
        return max(best(i + 1, j), best(i, j + 1), 1 + best(i + 1, j + 1) if want[i][:2] == made[j][:2] else 0)

    pairs, i, j = {}, 0, 0
    while i < len(want) and j < len(made):
        if want[i][:2] == made[j][:2]:
            pairs[i], i, j = j, i + 1, j + 1
        elif best(i + 1, j) >= best(i, j + 1):
            i += 1
        else:
            j += 1
    free, reasons = [j for j in range(len(made)) if j not in pairs.values()], []
    for i, (tool, x, _) in enumerate(want):
        j = next((j for j in free if made[j][0] == tool), None)
        if i in pairs or j is None:
            reasons.append("correct" if i in pairs else "missing")
        else:
            free.remove(j)
            reasons.append("out_of_order" if made[j][1] == x else "wrong_args:x")
    rounds = lambda calls: [[c[:2] for c in run] for _, run in itertools.groupby(calls, key=lambda c: c[2])]
    return len(pairs), len(free), rounds(want) == rounds(made), reasons + ["extra_call"] * len(free)


def test_random_segments_against_the_definition(spark):
    """Rounds whose numbers come back, repeated calls and few tools."""
    r = random.Random(5)
    some = lambda: [(r.choice("fg"), r.randrange(3), r.choice([1, 2, 1, 3])) for _ in range(r.randrange(1, 7))]
    pairs = [(x := some(), r.choice([some(), x[:], [(t, a, {1: 4, 2: 1, 3: 2}[n]) for t, a, n in x], x[1:] + x[:1]])) for _ in range(300)]
    calls = lambda side: [_call(t, json.dumps({"x": a}), n) for t, a, n in side]
    assert _compared(spark, [(calls(w), calls(m)) for w, m in pairs]) == [_plain_comparison(w, m) for w, m in pairs]
    assert _compared(spark, [([_call("f", "{}", n) for n in (1, 2, 3)], [_call("f", "{}", n) for n in (1, 2, 1)])])[0][2]


@pytest.mark.parametrize("name", ["call_details", "segment_scores", "task_scores"])
def test_calls_are_read_once(spark, small, name):
    """Two readings of arguments, one a side, and one comparison."""
    assert str(QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan()).count("ArrowEvalPython") == 3


def test_scores_of_compared_segments(spark):
    rows = lambda calls: spark.createDataFrame([(s, p, 1, t, a) for s, p, t, a in calls], CALLS)
    want, made = rows([(1, 0, "f", "{}"), (1, 1, None, "{}"), (1, 2, "g", "{}"), (2, 0, "f", "{}"), (None, 0, "f", "{}")]), rows([(1, 0, None, "[]"), (1, 1, "g", '{"x": 1}'), (1, 2, "g", "{}"), (3, 0, "f", "{}")])
    both = scoring.compared(want, made, ["seg"])
    details, scores = scoring.details_of(both, ["seg"]), scoring.scores_of(both, ["seg"])
    assert sorted(scores.collect()) == sorted(scoring.segment_scores(details, want, made, ["seg"]).collect()) == [(1, 3, 1, 2, False), (2, 1, 0, 0, False), (3, 0, 0, 1, False)]
    assert sorted(r.reason for r in details.collect()) == ["correct", "extra_call", "extra_call", "extra_call", "missing", "missing", "missing", "missing"]


def test_every_reason_occurs(spark, small):
    reasons = {r.reason for r in QUERIES["call_details"](spark, small).select("reason").distinct().collect()}
    assert reasons - {"wrong_args:at"} == {"correct", "missing", "extra_call", "out_of_order", "unparseable_args", "wrong_args:k"}  # at: a call left out before a changed one


def test_segment_match_of_whole_table(spark, small):
    calls = defaultdict(lambda: defaultdict(list))
    for r in table(spark, small, "events").orderBy("ts", "event_id").collect():
        calls[r.user_id][r.ts.date()].append(_call(r.event_type, r.props, r.ts.hour))
    got = {r.user_id: r for r in QUERIES["segment_match"](spark, small).collect()}
    assert set(got) == set(calls)
    for user, days in calls.items():
        want, made, r = days[min(days)], days[max(days)], got[user]
        same = [f"{c['tool']}{json.loads(c['args'])}" for c in want], [f"{c['tool']}{json.loads(c['args'])}" for c in made]
        assert r.correct == _lcs(*same) and len(r.reasons) == len(want) + r.extra and r.reasons.count("correct") == r.correct


def _read(spark, parser, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", parser.alias("p")).orderBy("i").collect()
    return [([(c.tool, json.loads(c.args)) for c in r.p.calls], r.p.malformed) for r in rows]


def test_call_parsers(spark):
    tag = lambda body: f"<tool_call>{body}</tool_call>"
    one = "<function=f><parameter=a>\n1\n</parameter></function>"
    twice = "<function=f><parameter=a>1</parameter><parameter=b>x</parameter><parameter=a>2</parameter></function>"
    good = [tag(one), "plain", None, "said " + tag(one) + "\n" + tag("<function=g></function>"), tag("<function=h><parameter=q>line\n\"two\" é</parameter>\n</function>")]
    got = _read(spark, scoring.tagged_calls(F.col("t")), good)
    assert got == [([("f", {"a": "1"})], False), ([], False), ([], False), ([("f", {"a": "1"}), ("g", {})], False), ([("h", {"q": 'line\n"two" é'})], False)]
    bad = _read(spark, scoring.tagged_calls(F.col("t")), [tag(one + one), tag("nothing"), tag(one + "rest"), tag(one) + "< tool_call", tag(twice), "<tool_call>" + one, tag("<function=f>text</function>")])
    assert all(b for _, b in bad) and bad[4][0] == [("f", {"a": "2", "b": "x"})] and len(bad[0][0]) == 2
    line = lambda body: f"<think>hm</think><|tool_call_start|>{body}<|tool_call_end|>"
    parser = scoring.bracketed_calls()(F.col("t"))
    assert _read(spark, parser, [line("[f(a=1, b='x'), g()]"), "none", None]) == [([("f", {"a": 1, "b": "x"}), ("g", {})], False), ([], False), ([], False)]
    broken = ["[f(1)]", "[f(a=1, a=2)]", "f(", "[]", "1", "[f(a=open('x'))]", "[f(**x)]", "[x.f(a=1)]"]
    assert _read(spark, parser, [line(b) for b in broken]) == [([], True)] * len(broken)
    ends = _read(spark, parser, [line("[f()]") + " and prose", line("f()") * 2, "<|tool_call_end|>f()<|tool_call_start|>", "<|tool_call_start|>f()"])
    assert ends == [([("f", {})], True)] + [([], True)] * 3


def test_reward_of_parsed_calls(spark):
    tag = lambda name, v: f"<tool_call><function={name}><parameter=a>{v}</parameter></function></tool_call>"
    rows = [(0, tag("f", 1)), (0, tag("f", 2)), (0, "quiet"), (1, "quiet"), (1, tag("f", 1)), (0, tag("f", 1) + tag("g", 1)), (0, tag("f", 1) + "<tool_call")]
    want = F.when(F.col("n") == 0, F.array(F.struct(F.lit("f").alias("tool"), F.lit('{"a": "1"}').alias("args"))))
    read = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(rows)], "i int, n int, t string").withColumn("p", scoring.tagged_calls(F.col("t")))
    got = [round(r.r, 6) for r in read.select("i", scoring.emission_reward()(want, "p.calls", "p.malformed").alias("r")).orderBy("i").collect()]
    assert got == [1.0, 0.0, 0.0, 1.0, 0.0, 0.7, 0.5]


def test_json_forms(spark):
    rows = ['{"b": 1, "a": [true, null]}', '{"e\u0301": 1, "\u00e9": 2}', "{1}", None, "[1.5, NaN]", '"x"']
    frame = spark.createDataFrame([(x,) for x in rows], "j string")
    got = [tuple(r) for r in frame.select(scalar.canonical_json("j"), scalar.loose_json("j")).collect()]
    assert got == [('{"a":[true,null],"b":1}', '{"a": [true, null], "b": 1}'), (None, '{"e\u0301": 1, "\u00e9": 2}'), (None, None), (None, None), (None, "[1.5, NaN]"), ('"x"', '"x"')]
    assert leaves.same([1, {"a": 2.0}], [1.0, {"a": 2}]) and not leaves.same([1], [True]) and not leaves.same(1, 1.0, False)
    assert not leaves.same({"a": ["x"]}, {"a": {"0": "x"}}) and not leaves.same({"a.b": 1}, {"a": {"b": 1}}) and not leaves.same({}, []) and not leaves.same("1", 1)


def test_joins_of_hot_and_other_keys_agree(spark):
    from traceloom.session import lookup, skew_join

    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(300)] + [(None, 1), (99, 2)], "k int, v int")
    right = left.where("k < 50").groupBy("k").count()
    for how in ("inner", "left"):
        want = sorted(map(repr, left.join(right, "k", how).collect()))
        assert sorted(map(repr, skew_join(left, right, ["k"], "count", how, top=2).collect())) == want
        assert sorted(map(repr, lookup(left, right, ["k"], "count", how, max_rows=1).collect())) == want


def test_graphs_without_a_cap(spark):
    chain = spark.createDataFrame([(i, f"n{i}", f"n{i + 1}") for i in range(14)], "edge_id int, a string, b string")
    assert [r.steps for r in graph.routes(chain, "n0", ("n14",)).collect()] == [14]
    assert graph.reachable(chain, "n0").count() == 15
    with pytest.raises(ValueError):
        graph.routes(chain, "n0", ("n14",), max_edges=5)


def test_records_on_empty_and_null_rows(spark):
    empty = spark.createDataFrame([], "key string, n long, part int, ok boolean")
    assert records.largest_remainder(empty, "key", "n", 5).count() == 0
    assert [r.state for r in records.pending(spark.createDataFrame([("a",)], "key string"), empty, "key").collect()] == ["pending"]
    assert records.complete_partition(empty, "part", empty, "key").count() == 0
    rows = spark.createDataFrame([(None, None), ("a", None), ("a", 5.0), ("b", None)], "g string, price double")
    assert sorted(map(str, (tuple(r) for r in records.within_budget(rows, "g", "price", 1.0).collect()))) == ["('a', None)", "('b', None)", "(None, None)"]


def test_conversations_of_either_form_ledgers_and_checked_writes(spark, tmp_path):
    texts = {"array": '[{"k": 1}, {"k": 2}]', "lines": '{"k": 1}\n\nno json\n{"k": 3}\n', "none": "\n \nno\n"}
    for name, t in texts.items():
        (tmp_path / f"{name}.json").write_text(t)
    read = lambda name: sorted(r.k for r in files.read_conversations(spark, str(tmp_path / f"{name}.json"), "k int").collect())
    assert read("array") == [1, 2] and read("lines") == [1, 3]
    with pytest.raises(ValueError):
        read("none")
    rows = spark.createDataFrame([(i, i, "x" * 300) for i in range(50, 0, -1)], "k int, id int, error string")
    assert files.write_checked(rows, str(tmp_path / "t")) == 50 and files.write_checked(rows, str(tmp_path / "t")) == 50
    files.append_ledger(rows, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).where("length(error) = 200").count() == 50
    files.write_merged(rows, str(tmp_path / "m"), "k", "id")
    assert [json.loads(x)["k"] for f in sorted((tmp_path / "m").glob("part-*")) for x in f.read_text().splitlines()] == list(range(1, 51))
    with pytest.raises(ValueError):
        files.write_merged(rows.withColumn("id", rows.k + 1), str(tmp_path / "n"), "k", "id")


def test_worlds_on_awkward_rows(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", ""), (1, 3, "tool", "r"), (1, 4, "tool", "r"), (1, 5, "assistant", "done"),
             (2, 0, "system", "s"), (2, 1, "user", None), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "a"), (3, 3, "user", "more")]
    plans = [(1, ["tools:2", "respond"]), (2, ["respond"]), (3, ["respond"]), (4, ["collect"])]
    got = worlds.replay_conversation(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"), spark.createDataFrame(plans, "conv_id int, actions array<string>"))
    assert {r.conv_id: (r.position, r.problem) for r in got.collect()} == {1: (None, None), 2: (1, "blank"), 3: (3, "goes on"), 4: (0, "ends early")}
    runs = spark.createDataFrame([("a", None), ("a", "x"), ("b", None), ("b", None), ("c", "x"), (None, "x")], "k string, r string")
    assert {r.k: r.status for r in worlds.determinism(runs, ["k"], "r").collect()} == {"a": "differs", "b": "equal", "c": "too few", None: "too few"}
    names = spark.createDataFrame([("", 1), (None, 1), ("ab", 2)], "place string, area int")
    found = spark.createDataFrame([(1, "xabx", 1, None), (2, None, 1, "lost"), (3, "", 1, ""), (4, "xabab", 2, "")], "id int, name string, area int, summary string")
    assert {r.id: r.suspect for r in worlds.suspects(found, names, "lost").collect()} == {1: True, 2: True, 3: False, 4: False}
    assert worlds.suspects(found.where("false"), names.where("false"), "lost").count() == 0
    entries = spark.createDataFrame([(0, "a", None, None, None), (1, "a", "r", None, None)], "ordinal int, key string, result string, key_sha256 string, result_sha256 string")
    assert sorted(r.problem for r in worlds.world_problems(entries).collect()) == ["key hash", "key hash", "repeated key", "result hash"]
    states = spark.createDataFrame([(0, 5, "f"), (1, 2, "f")], "epoch int, yielded int, fingerprint string")
    assert worlds.resume_point(states, "f") == (1, 2) and worlds.resume_point(states.where("false"), "f") == (0, 0)
    with pytest.raises(ValueError):
        worlds.resume_point(states, "g")


def test_ranks_of_a_large_and_small_groups(spark):
    rows = [("big" if i % 3 else f"g{i % 9}", i * 7919 % 1000 + i / 1e4, i % 4) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, x double, w long").repartition(5)
    want, total = {}, defaultdict(int)
    for g, x, w in sorted(rows):
        total[g] += w
        want[g, x] = total[g]
    got = ranks.running(df, ["g"], ["x"], "w").collect()
    assert {(r.g, r.x): r.upto for r in got} == want and all(r.total == total[r.g] for r in got)
    hashed = df.selectExpr("g", "sha2(cast(x AS string), 256) AS key")
    by = defaultdict(list)
    for r in hashed.collect():
        by[r.g].append(r.key)
    want = {(g, k): (i + 1, len(keys)) for g, keys in by.items() for i, k in enumerate(sorted(keys))}
    assert {(r.g, r.key): (r["rank"], r["n"]) for r in ranks.hash_ranks(hashed, "g", "key", 1).collect()} == want
    assert ranks.running(df.where("false"), ["g"], ["x"], "w").count() == 0


def test_schema_findings_of_single_values(spark):
    schema = {
        "type": "object", "required": ["a", "b"], "additionalProperties": False,
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"], "minLength": 2}, "l": {"type": "array", "maxItems": 2, "items": {"type": "object", "properties": {"n": {"type": "number"}}}}, "o'k": {"type": "boolean", "default": True}},
    }
    cases = {
        '{"a": 1, "b": "xy"}': [], '{"a": 1.0, "b": null, "l": []}': [], None: [("$", "required")], "oops": [("$", "json")], "[1]": [("$", "type")], '{"a": true, "b": "xy"}': [("$.a", "type")],
        '{"a": -1, "b": "x", "z": 1}': [("$.a", "minimum"), ("$.b", "minLength"), ("$.z", "additionalProperties")], '{"b": null}': [("$.a", "required")], '{"a": null, "b": null}': [("$.a", "type")],
        '{"a": 1, "b": null, "l": [{"n": 1.5}, {"n": "1"}, 3]}': [("$.l", "maxItems"), ("$.l[1].n", "type"), ("$.l[2]", "type")], '{"a": 1, "b": null, "o\'k": 0}': [("$.o'k", "type")], '{"a": 1, "a": 2, "b": null}': [("$", "json")],
    }
    rows = spark.createDataFrame([(x,) for x in cases], "j string")
    got = rows.select("j", schemas.violations(F.col("j"), schema).alias("f"), schemas.filled(F.col("j"), schema).alias("r")).collect()
    assert {r.j: sorted((f.path, f.rule) for f in r.f) for r in got} == {k: sorted(v) for k, v in cases.items()}
    assert {r.j: r.r["o'k"] for r in got if r.r} == {k: True for k, v in cases.items() if not v}
    for bad in ({"type": "object", "oneOf": []}, {"type": "string", "format": "email"}):
        with pytest.raises(ValueError):
            schemas.violations(F.col("j"), bad)


def test_schema_of_properties_read_at_once(spark):
    """Names that differ in case alone or hold dots and backticks, several types, no type, and orders judged on all partitions."""
    one = {"type": "integer", "minimum": 5}
    schema = {"type": ["object", "array"], "properties": {"n": one, "N": {"type": "string"}, "x.y": one, "`": {"enum": ["a"]}}, "required": ["N"], "additionalProperties": False, "items": {"maximum": 3}}
    cases = {
        '{"n": 4, "N": "a", "x.y": 5}': [("$.n", "minimum", "4")], '{"n": "6", "x.y": 1.5, "`": "b", "z": 0}': [("$.N", "required", None), ("$.n", "type", "string"), ("$.x.y", "type", "number"), ("$.`", "enum", '"b"'), ("$.z", "additionalProperties", None)],
        "[1, 4, null, \"5\"]": [("$[1]", "maximum", "4")], "7": [("$", "type", "integer")], "null": [("$", "type", "null")],
    }
    for only, is_ in (("object", "array"), (["array"], "object")):
        for text in ("[]", "{}"):
            found = spark.range(1).select(schemas.violations(F.lit(text), {"type": only, "properties": {"n": one}, "items": {}}).alias("f")).head().f
            assert [tuple(f) for f in found] == ([("$", "type", is_)] if (text == "[]") == (is_ == "array") else [])
    got = spark.createDataFrame([(x,) for x in cases], "j string").select("j", schemas.violations(F.col("j"), schema).alias("f")).collect()
    assert {r.j: [tuple(f) for f in r.f] for r in got} == cases
    orders, lines = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("orders", "lineitem"))
    assert contracts._orders(orders, lines).select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_audit_of_versions(spark):
    schema = "k int, j string, n int, key string"
    left = spark.createDataFrame([(1, '{"a": [1, {"b": 2}]}', 1, "x"), (None, "{}", 1, "x"), (2, "no json", None, "x"), (3, "{}", 1, "x"), (4, "{}", 1, "x"), (4, "{}", 1, "x"), (6, None, 1, "x")], schema)
    right = spark.createDataFrame([(1, '{"a": [1.0, {"b": "2", "c": null}]}', 1, "y"), (None, "[]", 1, "x"), (2, "no json!", 0, "x"), (4, "{}", 1, "x"), (5, "{}", 1, "x"), (6, "null", 1, "x")], schema)
    got = sorted(((r.k or 0, r.path, r.problem) for r in differences.audit(left, right, ["k"], ("j",)).collect()))
    assert got == [
        (0, "$.j", "type"), (1, "$.j.a[1].b", "type"), (1, "$.j.a[1].c", "only right"), (1, "$.key", "value"), (2, "$.j", "value"), (2, "$.n", "type"), (3, "$", "missing right"), (4, "$", "repeated left"), (5, "$", "missing left")]
    assert differences.audit(left.where("k <> 4"), left.where("k <> 4"), ["k"], ("j",)).isEmpty() and differences.audit(left.limit(0), right.limit(0), ["k"]).isEmpty()
    fewer = {(r.k, r.path, r.problem) for r in differences.audit(left.where("k = 3"), left.where("k = 3").drop("n"), ["k"]).collect()}
    assert fewer == {(3, "$.n", "only left")}


def test_exact_selection_against_all_choices(monkeypatch):
    r = random.Random(1)
    for _ in range(400):
        monkeypatch.setattr(selection, "TABLED", r.choice([0, 2, 5, 16]))
        d = r.randrange(1, 4)
        kinds = [(v, r.randrange(1, 4)) for v in {tuple(r.randrange(4) for _ in range(d)) for _ in range(r.randrange(1, 5))}]
        target = tuple(r.randrange(8) for _ in range(d))
        sums = lambda xs: tuple(sum(x * v[j] for x, (v, _) in zip(xs, kinds)) for j in range(d))  # noqa: B023, E731
        got = selection.solve(kinds, target)
        if got is None:
            assert all(sums(xs) != target for xs in itertools.product(*(range(n + 1) for _, n in kinds)))
        else:
            assert sums(got) == target and all(0 <= x <= n for x, (_, n) in zip(got, kinds))


def test_selection_without_an_answer_is_an_error(spark):
    rows = spark.createDataFrame([(g, r) for g in range(4) for r in "aab"], "g int, r string")
    assert selection.choose_groups(rows, "g", "r", {"a": 4, "b": 2}).count() == 2
    for targets in ({"a": 3, "b": 1}, {"a": 4}, {"a": 10, "b": 5}):
        with pytest.raises(ValueError):
            selection.choose_groups(rows, "g", "r", targets)
    assert selection.choose_groups(rows.limit(0), "g", "r", {"a": 0}).count() == 0


def test_cells_that_cannot_hold_a_hit_stay_closed(spark):
    """Clustered vectors, equal ones and a cell of many parts: as the full scan, with few cells opened."""
    import numpy as np

    r = np.random.default_rng(4)
    x = np.repeat(r.normal(size=(12, 16)), 60, axis=0) + 0.02 * r.normal(size=(720, 16))
    x = np.concatenate([x, np.tile(x[0], (200, 1))]).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, [0.0] * 16), (5000, None)], "vec_id long, embedding array<float>")
    hits, opened = hybrid.vector_search(hybrid.build_index(rows, n_cells=24, part_rows=50), rows.where("vec_id % 20 = 0 AND vec_id < 5000"), "vec_id", "embedding", 10)
    dots = x.astype(float) @ x.astype(float).T
    score = np.floor(np.abs(dots) * 1e4 + 0.5) * np.sign(dots) / 1e4
    want = {(i, j, k + 1) for i in range(0, 920, 20) for k, j in enumerate(sorted((j for j in range(920) if j != i), key=lambda j: (-score[i, j], j))[:10])}
    assert {(h.query_id, h.id, h["rank"]) for h in hits.collect()} == want
    seen = opened.collect()
    assert len(seen) == 46 and sum(o.opened for o in seen) < 0.5 * sum(o.cells for o in seen)
    none = hybrid.vector_search(hybrid.build_index(rows.limit(0)), rows.limit(0), "vec_id", "embedding", 3)
    assert none[0].count() == none[1].count() == 0


def test_search_uses_both_strategies(spark, small):
    assert {r.strategy for r in QUERIES["hybrid_search"](spark, small).select("strategy").distinct().collect()} == {"location_priority", "hybrid_fallback"}


def test_capped_episodes_as_a_stream(spark, small, tmp_path):
    """Shuffled micro-batches give what the windows give over the table; an action behind the watermark changes nothing."""
    from datetime import datetime, timedelta

    r, t0 = random.Random(8), datetime(2024, 1, 1)
    kinds = ["person", "ask", "tool", "final", "other"]
    rows = [(f"e{i % 12}", t0 + timedelta(seconds=20 * i + r.randrange(20)), i, r.choices(kinds, [{0: 1, 1: 9, 2: 3}[i % 3], 3, 3, 1, 1])[0], r.choice(["a", "b", None])) for i in range(900)]
    table_ = spark.createDataFrame(rows, "episode string, ts timestamp, seq long, kind string, slot string")
    want = sorted(map(tuple, capped.ended(table_).collect()))
    assert len({w[1] for w in want}) >= 2
    end = rows[-1][1]
    parts = [r.sample(rows[k : k + 300], 300) for k in range(0, 900, 300)]
    parts += [[("far", end + timedelta(hours=9), 0, "other", None)], [("e0", t0, 10_000 + k, "final", None) for k in range(3)] + [("far", end + timedelta(hours=20), 1, "other", None)]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, table_.schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    capped.keep_in_rocksdb(spark)
    try:
        stream = spark.readStream.schema(table_.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        seen = []
        q = capped.stream_ended(stream, "2 hours").writeStream.outputMode("append").foreachBatch(lambda b, _: seen.extend(map(tuple, b.collect()))).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted(seen) == want


def test_every_cap_is_reached(spark):
    from datetime import datetime, timedelta

    at = lambda i: datetime(2024, 1, 1) + timedelta(seconds=i)
    lives = {"rounds": ["person"] + (["ask"] * 5 + ["person"]) * 6, "turn": ["person"] + ["ask"] * 9, "turns": ["person", "ask"] * 9, "done": ["person", "final", "final"], "open": ["person", "other"]}
    rows = [(e, at(i), i, k, "x") for e, kinds in lives.items() for i, k in enumerate(kinds)]
    got = {r.episode: (r.outcome, r.rounds, r.turns, r.violations, r.reward) for r in capped.ended(spark.createDataFrame(rows, "episode string, ts timestamp, seq long, kind string, slot string")).collect()}
    assert got == {
        "rounds": ("max_assistant_rounds", 24, 5, 25, 0.0), "turn": ("max_rounds_per_user_turn", 6, 1, 7, 0.0), "turns": ("max_person_turns", 7, 8, 8, 0.0), "done": ("done", 1, 1, 0, 1.5)}


def test_bad_lines_are_named(spark, tmp_path):
    """Files of many blocks, blank lines, line ends of both kinds; the first bad line by file, at any split size."""
    r = random.Random(6)
    for name, wrong in (("a", None), ("b", 777), ("c", 5)):
        body = ["" if r.random() < 0.1 else json.dumps({"k": i, "t": "x" * r.randrange(60)}) for i in range(1000)]
        if wrong:
            body[wrong - 1] = r.choice(['{"k": "no number"}', "[1]", "{k"])
        (tmp_path / f"{name}.jsonl").write_bytes(("\r\n" if name == "b" else "\n").join(body).encode() + b"\n")
    lines = {(f, i + 1): x for f in "abc" for i, x in enumerate((tmp_path / f"{f}.jsonl").read_text().split("\n")[:-1])}
    for size in ("1000", "70000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {(x.file[-7], x.line): x.text for x in lines_of.numbered(spark, str(tmp_path)).collect()}
            assert got == lines
            with pytest.raises(ValueError, match=r"b\.jsonl, line 777:"):
                lines_of.read_strict(spark, str(tmp_path), "k long, t string")
            good = lines_of.read_strict(spark, str(tmp_path / "a.jsonl"), "k long, t string")
            assert good.columns == ["k", "t"] and good.count() == sum(x != "" for (f, _), x in lines.items() if f == "a")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_keyed_table_takes_a_batch_once(spark, tmp_path):
    schema, path = "k int, at int, v string", str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(rows, schema)
    t = KeyedTable(spark, path, ["k"], ["at"], buckets=4)
    rows = lambda: sorted(((x.k or 0, x.at, x.v) for x in t.read().collect()))
    assert t.read() is None and t.write(make((1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x"), (None, 1, "n")), 0)
    assert rows() == [(0, 1, "n"), (1, 3, "c"), (2, 1, "x")]
    assert t.write(make((2, 0, "y"), (3, 1, "z")), 4) and rows() == [(0, 1, "n"), (1, 3, "c"), (2, 0, "y"), (3, 1, "z")]
    before = rows()
    assert not t.write(make((2, 9, "again")), 4) and not t.write(make((2, 9, "again")), 3) and rows() == before
    make((9, 9, "lost")).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{path}/data/000000000009-lost")  # a batch that never was committed
    (tmp_path / "t/manifest/half.tmp").write_text("{")
    assert rows() == before and t.write(make(), 5) and rows() == before
    with pytest.raises(ValueError):
        t._commit({"batch": 5, "of": {}, "schema": schema})
    ledger = KeyedTable(spark, str(tmp_path / "u"), ["k"], immutable=True, buckets=2)
    assert ledger.write(make((1, 1, "a"), (1, 1, "a")), 0) and ledger.write(make((1, 1, "a"), (2, 2, "b")), 1)
    for bad in (make((1, 1, "other")), make((7, 1, "a"), (7, 2, "a"))):
        with pytest.raises(ValueError):
            ledger.write(bad, 2)
    assert ledger.read().count() == 2 and ledger.manifest()["batch"] == 1


def test_keyed_table_behind_a_stream(spark, tmp_path):
    schema = "k int, at int, v string"
    for i in range(3):
        spark.createDataFrame([(k, i, f"{i}") for k in range(i, i + 3)], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], buckets=3)

    def twice(batch, i):
        assert t.write(batch, i) and not t.write(batch, i)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(0, "0"), (1, "1"), (2, "2"), (3, "2"), (4, "2")]


def test_mixed_batches(spark):
    types, counts = {"x": {"a": 3, "b": 1}, "y": {"a": 1, "b": 3}}, {"x": 5, "y": 4}
    rows = spark.createDataFrame([(i, "a" if i < 15 else "b") for i in range(30)], "id int, s string")  # 19 places for 15 a's, 17 for 15 b's
    got = sampling.stratified(rows, "id", "s", types, counts)
    assert sampling.stratified_problems(got, rows, "id", "s", types, counts).isEmpty()
    out = got.collect()
    assert sorted((r.batch, r.slot) for r in out) == [(b, s) for b in range(9) for s in range(4)]
    for least in range(9):
        assert len({r.id for r in out if r.batch == least}) == 4
    assert sum(r.occurrence == 2 for r in out) == 6 and {r.id for r in out if r.occurrence == 1} == set(range(30))
    for bad in ({"x": 1, "y": 1}, {"x": 20, "y": 20}):
        with pytest.raises(ValueError):
            sampling.stratified(rows, "id", "s", types, bad)
    assert {r.problem for r in sampling.stratified_problems(got.where("batch <> 2 OR slot <> 1").union(got.where("batch = 3 AND slot = 0")), rows, "id", "s", types, counts).collect()} >= {"batch of no type", "twice in a batch"}


def test_rules_of_texts_and_words_for_dates(spark):
    from datetime import date

    said = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 4)), (date(2024, 1, 8), date(2024, 1, 7)), (date(2024, 1, 14), date(2024, 1, 1)), (date(2024, 1, 20), date(2024, 1, 1))], "day date, today date")
    got = [set(r[0]) for r in said.select(text_rules.date_words(F.col("day"), F.col("today"))).collect()]
    assert got[0] == {"1月5日", "1月5号", "2024-01-05", "明天", "这周五", "本周五", "周五"} and got[1] == {"1月8日", "1月8号", "2024-01-08", "明天", "下周一"}
    assert got[2] == {"1月14日", "1月14号", "2024-01-14", "下周日"} and got[3] == {"1月20日", "1月20号", "2024-01-20"}
    rules = spark.createDataFrame([("city", "any", "must", "in {city}!"), ("window", "user", "weekday window", ""), ("week", "first user", "relative date", ""), ("last", "last assistant", "must not", r"\\d")], "rule string, scope string, kind string, pattern string")
    messages = spark.createDataFrame([(1, 0, "user", "in a.b(c! 下周五 周边"), (1, 1, "assistant", "in a.b(c! 1"), (1, 2, "user", "in axb(c! 周六"), (1, 3, "assistant", None), (2, 0, "user", "周一")], "conv_id int, turn int, role string, text string")
    facts = spark.createDataFrame([(1, date(2024, 1, 5), date(2024, 1, 4), 1, "a.b(c")], "conv_id int, day date, today date, days int, city string")
    found = {(r.conv_id, r.rule): (r.status, r.n, r.turn) for r in text_rules.audit(messages, facts, rules).collect()}
    assert found == {(1, "city"): ("FAIL", 4, 2), (1, "window"): ("FAIL", 2, 2), (1, "week"): ("FAIL", 1, 0), (1, "last"): ("PASS", 1, None)}
    with pytest.raises(ValueError):
        text_rules.audit(messages, facts, rules.union(rules))


def test_both_outcomes_of_text_rules(spark, small):
    got = defaultdict(set)
    for r in QUERIES["text_rules"](spark, "/root/testdata/sf0.01").select("rule", "status").distinct().collect():
        got[r.rule].add(r.status)
    assert len(got) >= 20 and sum(len(v) == 2 for v in got.values()) >= 10


def test_replies(spark, small):
    got = QUERIES["replies"](spark, small).collect()
    assert {r.act for r in got} == {"ask", "final", "refusal", "invalid"} and {r.slot for r in got} >= {"travel_date", "hotel_name", "destination", "route_destination", "unknown", None}
    assert len({r.substantial for r in got}) == 2 and len({r.rating for r in got}) > 3
    one = lambda c: spark.range(1).select(c).head()[0]
    rated = {"评分：4.5分": 4.5, "9/10": 4.5, "6.7 / 10, 4.1/5": 4.1, "评分 9, 8/10": 4.0, "7分": None, "none": None}
    assert {t: one(dialogue.rating(F.lit(t))) for t in rated} == rated
    assert one(dialogue.act(F.lit(None).cast("string")))["rule"] == "empty" and one(dialogue.act(F.lit("抱歉 暂时！"), ("抱歉暂时。",)))["act"] == "refusal"
    assert [one(dialogue.weather(F.lit(c), F.lit(p))) for c, p in ((77, "night"), (86, "day"), (4, "day"), (0, "noon"))] == ["雪", "大雪", "未知", "未知"]
