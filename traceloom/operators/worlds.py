"""Sealed worlds, replays, digests, schedules, label quotas, grounding and promotion.

Nulls: a null key meets no other, and a check whose value is null fails. Empty
tables give empty results; repeated rows count as often as they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import cut, small_side

#: Fixed value: the name that a described tree gives its algorithm.
TREE_ALGORITHM = "sha256-tree-v1"


def tree_digests(files: DataFrame, tree: str, algorithm: str = TREE_ALGORITHM) -> DataFrame:
    """(tree, n_files, bytes, listed, framed, described) over files (path, sha256, size) of each tree, in order of path.

    ``listed`` hashes lines of path, NUL and hex digest; ``framed`` the path's
    length in eight bytes, the path and the raw digest; ``described`` compact
    JSON of the list with its totals. A hash needs its input in one piece, so
    the list of one tree is one row.
    """
    by = files.groupBy(tree).agg(F.array_sort(F.collect_list(F.struct("path", "sha256", "size"))).alias("files"))
    total = F.aggregate("files", F.lit(0).cast("long"), lambda a, x: a + x["size"])
    lines = F.transform("files", lambda x: F.concat(x["path"], F.lit("\0"), x["sha256"], F.lit("\n")))
    frames = F.transform("files", lambda x: F.concat(F.lpad(F.hex(F.octet_length(x["path"]).cast("long")), 16, "0"), F.hex(F.encode(x["path"], "utf-8")), x["sha256"]))
    described = F.to_json(F.struct(F.lit(algorithm).alias("algorithm"), F.size("files").alias("file_count"), "files", total.alias("total_bytes")))
    return by.select(
        tree, F.size("files").cast("long").alias("n_files"), total.alias("bytes"), F.sha2(F.array_join(lines, ""), 256).alias("listed"),
        F.sha2(F.unhex(F.array_join(frames, "")), 256).alias("framed"), F.sha2(described, 256).alias("described"))


def named_files(files: DataFrame, name: str, registry: DataFrame, code: str, ending: str = "_travel_guide.txt") -> DataFrame:
    """Files named code, ``_``, place and ``ending``, with ``code`` and ``place`` and the registry's columns; unknown codes are left out."""
    base = F.replace(F.regexp_extract(name, "([^/]*)$", 1), F.lit(ending), F.lit(""))
    parts = files.withColumn("base", base).where(F.col("base").contains("_"))
    parts = parts.withColumn(code, F.split_part("base", F.lit("_"), F.lit(1))).withColumn("place", F.expr("substring(base, instr(base, '_') + 1)"))
    return parts.drop("base").join(small_side(registry), code)


def listed_names(nested: DataFrame, column: str) -> DataFrame:
    """(owner, name) of JSON objects owner -> kind -> list or single value: the names in lists, each pair once."""
    kinds = nested.select(F.explode(F.from_json(column, "map<string, map<string, string>>")).alias("owner", "kinds"))
    lists = kinds.select("owner", F.explode("kinds").alias("kind", "value")).where(F.col("value").startswith("["))
    return lists.select("owner", F.explode(F.from_json("value", "array<string>")).alias("name")).distinct()


def holding(rows: DataFrame, text: str, names: DataFrame, name: str) -> DataFrame:
    """(row, held) pairs whose text holds the name anywhere.

    Texts, which should be short, are cut into their pieces of each length that
    names have; pieces are the join key, so no nested loop is needed. The
    driver learns the lengths alone.
    """
    known = names.select(F.col(name).alias("held")).where(F.length("held") > 0).distinct()
    lengths = [r.n for r in known.select(F.length("held").alias("n")).distinct().orderBy("n").collect()]
    none = F.array().cast("array<string>")

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - n + 1)
        return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substr(F.col(text), i, F.lit(n)))).otherwise(none)

    cut = F.array_distinct(F.flatten(F.array(*map(pieces, lengths)))) if lengths else none
    return rows.withColumn("held", F.explode(cut)).join(small_side(known), "held")


def suspects(found: DataFrame, registry: DataFrame, pattern: str) -> DataFrame:
    """(id, suspect) of evidence (id, name, area, summary): the summary has the pattern, or the name holds a place of another area."""
    places = small_side(registry.select(F.col("place").alias("held"), F.col("area").alias("other")))
    away = holding(found.select("id", "name", "area"), "name", registry.where(F.length("place") >= 2), "place").join(places, "held").where("other <> area")
    both = found.join(away.select("id", F.lit(True).alias("away")).distinct(), "id", "left")
    return both.select("id", (F.coalesce(F.col("summary").rlike(pattern), F.lit(False)) | F.col("away").isNotNull()).alias("suspect"))


def order_routes(routes: DataFrame, group: str, ident: str, prefix: str = "R") -> DataFrame:
    """(group, ident, tag): routes (asks, tools, steps, labels) of a group by number of asks, asks, most tools, most steps and labels.

    The first 26 get letters, others numbers. A group is one graph's catalogue of routes.
    """
    order = Window.partitionBy(group).orderBy(F.size("asks"), "asks", F.desc("tools"), F.desc("steps"), "labels", ident)
    ranked = routes.withColumn("rank", F.row_number().over(order) - 1)
    mark = F.when(F.col("rank") < 26, F.char(F.col("rank") + 65)).otherwise((F.col("rank") + 1).cast("string"))
    return ranked.select(group, ident, F.concat(F.lit(prefix + "-"), mark).alias("tag"))


def schedule_audit(schedule: DataFrame, source: DataFrame, group: str, ident: str, size: int, most: int) -> DataFrame:
    """(rule, bad, status) of a schedule (group, ident, batch): every source is in it, none too often, every batch is full and distinct."""
    schedule = cut(schedule.select(group, ident, "batch"))  # by batches and by idents; a task that made it needs its memory no more
    seen = source.select(ident, F.lit(1).alias("there"), F.lit(0).alias("put")).union(schedule.select(ident, F.lit(0), F.lit(1))).groupBy(ident).agg(F.max("there").alias("there"), F.sum("put").alias("n"))
    missing = ((F.col("n") == 0) | F.col(ident).isNull()) & (F.col("there") == 1)  # a null is nowhere
    seen = seen.agg(F.count_if(missing).alias("missing"), F.count_if(F.col("n") > most).alias("often"))
    batches = schedule.groupBy(group, "batch").agg(F.count("*").alias("n"), F.count_distinct(ident).alias("d"))
    batches = batches.agg(F.count_if((F.col("n") != size) | (F.col("d") != size)).alias("bad"))
    rules = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(c).alias("bad")) for name, c in (("covers the sources", "missing"), ("occurrences", "often")))))
    out = seen.select(rules.alias("r")).select("r.*").union(batches.select(F.lit("full batches"), "bad"))
    return out.select("rule", "bad", F.when(F.col("bad") == 0, "PASS").otherwise("FAIL").alias("status"))


def world_problems(entries: DataFrame) -> DataFrame:
    """(problem, ordinal) of sealed entries (ordinal, key, result, key_sha256, result_sha256).

    Both hashes are taken again, keys are unique and rise with the ordinal. The
    order is tested by a join with the next ordinal, not by one window over all.
    """
    wrong = lambda c: ~F.col(f"{c}_sha256").eqNullSafe(F.sha2(F.col(c), 256))
    own = entries.select("ordinal", F.explode(F.filter(F.array(F.when(wrong("key"), "key hash"), F.when(wrong("result"), "result hash")), lambda x: x.isNotNull())).alias("problem"))
    later = entries.groupBy("key").agg(F.min("ordinal").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = entries.join(later, "key").where("ordinal > first").select("ordinal", F.lit("repeated key").alias("problem"))
    after = entries.select((F.col("ordinal") - 1).alias("ordinal"), F.col("key").alias("next"))
    order = entries.join(after, "ordinal").where("next < key").select("ordinal", F.lit("order").alias("problem"))
    return own.unionByName(again).unionByName(order).select("problem", "ordinal")


def determinism(runs: DataFrame, key: list[str], result: str, least: int = 2) -> DataFrame:
    """(key, replays, status): whether the replays of a key are enough and have one result, a null being one of them."""
    each = runs.groupBy(*key, F.col(result).cast("string").alias("one_result")).agg(F.count("*").alias("n"))
    by = each.groupBy(*key).agg(F.sum("n").alias("replays"), F.count("*").alias("results"))
    return by.select(*key, "replays", F.when(F.col("replays") < least, "too few").when(F.col("results") > 1, "differs").otherwise("equal").alias("status"))


def replay_conversation(messages: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, position, problem): where a conversation first departs from its plan, both null where it follows it.

    Plans have (conv_id, actions): ``collect`` asks and is answered, ``respond``
    ends, ``tools:N`` calls N tools in one round. A conversation opens with
    system and user. Texts must not be blank, but for the message that calls.
    """
    calls = lambda a: F.coalesce(F.split_part(a, F.lit(":"), F.lit(2)).try_cast("int"), F.lit(1))
    step = lambda role, may_be_blank=False: F.struct(F.lit(role).alias("role"), F.lit(may_be_blank).alias("blank"))
    roles = lambda a: (F.when(a == "collect", F.array(step("assistant"), step("user")))
                       .when(a.startswith("tools"), F.concat(F.array(step("assistant", True)), F.array_repeat(step("tool"), calls(a))))
                       .otherwise(F.array(step("assistant"))))
    want = plans.select("conv_id", F.concat(F.array(step("system"), step("user")), F.flatten(F.transform("actions", roles))).alias("want"))
    made = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", (F.trim(F.coalesce("text", F.lit(""))) == "").alias("blank")))).alias("made"))
    at = want.join(made, "conv_id", "left").withColumn("made", F.coalesce("made", F.expr("slice(made, 1, 0)"), F.array().cast("array<struct<turn:int,role:string,blank:boolean>>")))
    said = F.zip_with("want", "made", lambda w, m: F.when(w.isNull(), "goes on").when(m.isNull(), "ends early").when(~w["role"].eqNullSafe(m["role"]), "another role").when(m["blank"] & ~w["blank"], "blank"))
    first = F.array_position(F.transform(said, lambda s: s.isNotNull()), True)
    found = at.withColumn("said", said).withColumn("first", F.nullif(first, F.lit(0).cast("long")))
    return found.select("conv_id", (F.col("first") - 1).alias("position"), F.when(F.col("first").isNotNull(), F.try_element_at("said", F.col("first").cast("int"))).alias("problem"))


def label_quota(rows: DataFrame, group: str, label: str, ident: str, wanted: dict[str, tuple[int, int]]) -> DataFrame:
    """(group, label, ident, side): of each label in each group so many rows, the second number of them held out, by hash of the identifier.

    The largest number is a literal bound of the rank, so a task sends on no more than that of a group.
    """
    most = max((n for n, _ in wanted.values()), default=0)
    want = F.create_map(*[F.lit(x) for k, (n, held) in wanted.items() for x in (k, n)])
    held = F.create_map(*[F.lit(x) for k, (n, held) in wanted.items() for x in (k, held)])
    order = Window.partitionBy(group, label).orderBy(F.sha2(F.concat(F.lit("quota:"), F.col(ident).cast("string")), 256), ident)
    ranked = rows.where(F.col(label).isin(*wanted)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    side = F.when(F.col("rank") <= held[F.col(label)], "held_out").otherwise("train")
    return ranked.where(F.col("rank") <= want[F.col(label)]).select(group, label, ident, side.alias("side"))


def one_sided(rows: DataFrame, entity: str, side: str, sides: tuple[str, ...]) -> DataFrame:
    """(entity, missing): entities that some side of a split lacks, and those sides joined by commas."""
    seen = rows.groupBy(entity).agg(F.collect_set(side).alias("seen"))
    return seen.select(entity, F.array_join(F.array_except(F.array(*map(F.lit, sides)), "seen"), ",").alias("missing")).where("missing <> ''")


def answer_rules(text: Column, mentions: Column, letters: int = 24, words: int = 8) -> dict[str, Column]:
    """Rules of a final answer: enough letters and digits, enough words, every mention in it. For ``records.rule_table``."""
    return {
        "letters": F.length(F.regexp_replace(text, "[^A-Za-z0-9]", "")) >= letters,
        "words": F.size(F.regexp_extract_all(text, F.lit(r"(\S+)"), F.lit(1))) >= words,
        "mentions": F.forall(mentions, lambda m: F.contains(text, m)),
    }


def ungrounded(answers: DataFrame, ident: str, text: str, pattern: str, results: DataFrame, value: str) -> DataFrame:
    """(ident, fact): facts of the pattern's first group in a text that no result (ident, value) of the same record has."""
    facts = answers.select(ident, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))).alias("fact"))
    return facts.join(results.select(ident, F.col(value).alias("fact")), [ident, "fact"], "left_anti")


def canonical_codes(rows: DataFrame, column: str, aliases: DataFrame, alias: str, code: str) -> DataFrame:
    """``column`` with any known alias, whatever its case and outer spaces, made its code; other values stay. An alias of several codes means the least."""
    folded = lambda c: F.lower(F.trim(F.col(c).cast("string")))
    known = aliases.select(folded(alias).alias("folded"), F.col(code).alias("code")).groupBy("folded").agg(F.min("code").alias("code"))
    met = rows.withColumn("folded", folded(column)).join(small_side(known), "folded", "left")
    return met.withColumn(column, F.coalesce(F.col("code").cast("string"), F.col(column).cast("string"))).drop("folded", "code")


def promotion(metrics: DataFrame, baseline: str, margin: float) -> DataFrame:
    """(run, failed, promoted) of runs (run, metric, value, higher_is_better): none of a baseline's metrics is missing or worse by more than the margin."""
    base = metrics.where(F.col("run") == baseline).select("metric", F.col("value").alias("base"), "higher_is_better")
    runs = metrics.where(F.col("run") != baseline).select("run").distinct()
    want = runs.withColumn("metric", F.explode(F.array(*[F.lit(r.metric) for r in base.select("metric").distinct().orderBy("metric").collect()])))
    met = want.join(metrics.select("run", "metric", "value"), ["run", "metric"], "left").join(small_side(base), "metric")
    gain = F.when(F.col("higher_is_better"), F.col("value") - F.col("base")).otherwise(F.col("base") - F.col("value"))
    failed = F.count_if(~F.coalesce(gain >= -margin, F.lit(False)))
    return met.groupBy("run").agg(failed.alias("failed")).select("run", "failed", (F.col("failed") == 0).alias("promoted"))


def exact_first(asked: DataFrame, entries: DataFrame, ranked: DataFrame) -> DataFrame:
    """(query_id, entry_id, how): entries whose code, name or alias is the query, else the first of a ranking (query_id, entry_id, rank).

    ``entries`` has (entry_id, names), an array of all its forms. Case and outer spaces do not count.
    """
    fold = lambda c: F.lower(F.trim(c))
    forms = entries.select("entry_id", F.explode(F.array_distinct(F.transform("names", fold))).alias("form"))
    exact = asked.select("query_id", fold(F.col("query")).alias("form")).join(forms, "form").groupBy("query_id").agg(F.min("entry_id").alias("entry_id"))
    rest = ranked.join(exact, "query_id", "left_anti").groupBy("query_id").agg(F.min_by("entry_id", F.struct("rank", "entry_id")).alias("entry_id"))
    return exact.withColumn("how", F.lit("exact")).unionByName(rest.withColumn("how", F.lit("ranked")))


def probe_rules(k: int, base: int) -> dict[str, Column]:
    """Rules of a probe (position, attempts, an array of attempt, seed and reward), for ``records.rule_table``."""
    seeds = F.forall("attempts", lambda a: a["seed"] == F.lit(base) + F.col("position") * 10_000 + a["attempt"] * 100)
    return {
        "attempts": (F.size("attempts") == k) & (F.array_distinct(F.col("attempts.attempt")) == F.sequence(F.lit(0), F.lit(k - 1))),
        "seeds": seeds,
        "rewards": F.forall("attempts", lambda a: a["reward"].between(0.0, 1.5)),
    }


def bundle(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(name, status) of a release's files and its manifest, both (name, sha256, bytes, role): ok, missing, extra, or what differs first."""
    other = manifest.select("name", *[F.col(c).alias(f"want_{c}") for c in ("sha256", "bytes", "role")]).withColumn("listed", F.lit(True))
    both = files.withColumn("there", F.lit(True)).join(other, "name", "full")
    status = F.when(F.col("there").isNull(), "missing").when(F.col("listed").isNull(), "extra")
    for c in ("sha256", "bytes", "role"):
        status = status.when(~F.col(c).eqNullSafe(F.col(f"want_{c}")), c)
    return both.select("name", status.otherwise("ok").alias("status"))


def resume_point(state: DataFrame, fingerprint: str) -> tuple[int, int]:
    """(epoch, yielded) of a sampler's saved row (epoch, yielded, fingerprint); a row of another schedule is an error."""
    found = state.orderBy(F.desc("epoch"), F.desc("yielded")).limit(1).collect()
    if not found:
        return 0, 0
    if found[0].fingerprint != fingerprint:
        raise ValueError("the saved state is of another schedule")
    return found[0].epoch, found[0].yielded
