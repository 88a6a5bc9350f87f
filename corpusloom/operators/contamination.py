"""Contamination rules: scenarios made of phrases, and of terms that stand near each other.

A rule has scenario, rule, kind, window and groups: kind `phrase` looks for any of the terms; kind
`cooccurrence` for terms of all groups within `window` characters, counted from start to start.  Texts are compared in
their plain form; a term matches as whole words, with any white space between them.

Phrases are found by an index, so a rule may have thousands.  Words, pairs of words and pairs of pairs of a text are hashed,
each from the hashes before; a phrase is known by the hash of its first four, two or one words.  Hashes of a text that are in
the set of those of phrases are looked up in a hash table that every row shares, and only the phrases found there are tried
as patterns.  So the time for a text does not depend on the number of phrases, but on those whose first words it has.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import plain, plain_form
from ..functions.text import WORD, excerpt
from ..staging import bound_batches, shared_table

#: Fixed value: characters within which terms stand near each other, if a rule does not say.
WINDOW = 400


def load_rules(config: str) -> list[dict]:
    """The rules of a JSON configuration, in order; scenarios that are not enabled are left out."""
    out = []
    for scenario in json.loads(config)["scenarios"]:
        if not scenario.get("enabled", True):
            continue
        for rule in scenario["rules"]:
            kind = rule["type"]
            if kind == "phrase":
                groups = [rule["phrases"]]
            elif kind == "cooccurrence":
                groups = rule["groups"]
            else:
                raise ValueError(f"unknown rule type: {kind}")
            out.append({"scenario": scenario["id"], "rule": rule.get("id", kind), "kind": kind, "window": int(rule.get("window_chars", WINDOW)), "groups": groups})
    if not out:
        raise ValueError("no active rule")
    return out


def term_pattern(term: str) -> str:
    """A term in plain form as a pattern; its words are literal."""
    words = plain_form(term).split()
    quoted = r"\s+".join("".join(c if re.fullmatch(r"\w", c) else "\\" + c for c in w) for w in words)
    return rf"(?<![{WORD}]){quoted}(?![{WORD}])"


def _opening(term: str) -> str:
    return (plain_form(term).split() or [""])[0]


def _has(text: Column, term: str) -> Column:
    """Cheap containment of the first word before the pattern is tried."""
    return F.contains(text, F.lit(_opening(term))) & F.regexp_like(text, F.lit(term_pattern(term)))


def _starts(text: Column, term: str) -> Column:
    """array<int> of the starts of a term's hits, from the texts between them."""
    pattern = term_pattern(term)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("p"), found.alias("m")), lambda x: x["m"].isNotNull())
    none = F.expr("cast(array() as array<int>)")

    def step(held: Column, x: Column) -> Column:
        start = held["at"] + F.length(x["p"])
        return F.struct((start + F.length(x["m"])).alias("at"), F.concat(held["out"], F.array(start)).alias("out"))

    places = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda held: held["out"])
    return F.when(_has(text, term), places).otherwise(none)


def _hit(term: str, group: int):
    return lambda start: F.struct(start.alias("start"), F.lit(term).alias("term"), F.lit(group).alias("grp"))


def _windows(text: Column, groups: list[list[str]], size: int) -> Column:
    """array<struct<position, terms>>: the windows with hits of all groups, none of which overlap.

    Hits are read in order; those further back than the window are forgotten, and after a window all are.
    """
    hits = F.array_sort(F.concat(*(F.transform(_starts(text, t), _hit(t, g)) for g, terms in enumerate(groups) for t in terms)))
    none = F.expr("cast(array() as array<struct<position:int,terms:array<string>>>)")
    empty = F.expr("cast(array() as array<struct<start:int,term:string,grp:int>>)")

    def step(held: Column, hit: Column) -> Column:
        near = F.concat(F.filter(held["open"], lambda x: hit["start"] - x["start"] <= size), F.array(hit))
        full = F.size(F.array_distinct(F.transform(near, lambda x: x["grp"]))) == len(groups)
        terms = F.array_sort(F.array_distinct(F.transform(near, lambda x: x["term"])))
        match = F.struct(F.get(near, 0)["start"].alias("position"), terms.alias("terms"))
        return F.struct(F.when(full, empty).otherwise(near).alias("open"), F.when(full, F.concat(held["out"], F.array(match))).otherwise(held["out"]).alias("out"))

    present = [_any(text, terms) for terms in groups]
    found = F.aggregate(hits, F.struct(empty.alias("open"), none.alias("out")), step, lambda held: held["out"])
    every = present[0]
    for p in present[1:]:
        every &= p
    return F.when(every, found).otherwise(none)


def _any(text: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out |= _has(text, t)
    return out


#: Words of the n-grams by which phrases are known: of each phrase the most of these that it has.
ANCHORS = (4, 2, 1)
ENTRY = "struct<hash:long,rule:int,place:int,term:string,pattern:string>"


def _grams(text: str, longest: int) -> dict[str, Column]:
    """Columns to add one after another, so that each is computed once: __grams1, 2, 4 with the hashes of all n-grams of
    the words of a text column, from each word on.  The last ones of 2 and 4 run over the end; patterns settle that."""
    pair = lambda a, b: F.xxhash64(a, b)
    out = {"__grams1": F.transform(F.regexp_extract_all(F.col(text), F.lit(f"[{WORD}]+"), F.lit(0)), lambda w: F.xxhash64(w))}
    for n in (2, 4):
        if n <= longest:
            out[f"__grams{n}"] = F.zip_with(f"__grams{n // 2}", F.slice(f"__grams{n // 2}", n // 2 + 1, 1 << 30), pair)
    return out


def _indexed(phrases: list[tuple[int, int, str]]) -> tuple[dict[int, list[int]], list[dict]]:
    """({words: hashes of first so many words}, an entry a phrase) of (rule, place in it, phrase).  A phrase without words
    has a null hash.  The hashes are Spark's own: the phrases go through the expression that texts go through."""
    rows = [(rule, place, term, plain_form(term), term_pattern(term)) for rule, place, term in phrases]
    table = SparkSession.active().createDataFrame(rows, "rule int, place int, term string, form string, pattern string").coalesce(1)
    for name, grams in _grams("form", max(ANCHORS)).items():
        table = table.withColumn(name, grams)
    words, first = F.size("__grams1"), F.lit(None).cast("long")
    for n in reversed(ANCHORS):
        first = F.when(words >= n, F.get(f"__grams{n}", 0)).otherwise(first)
    known = table.select("rule", "place", "term", "pattern", first.alias("hash"), F.coalesce(*(F.when(words >= n, n) for n in ANCHORS)).alias("n")).collect()  # a row a phrase
    sets = {n: sorted({r.hash for r in known if r.n == n}) for n in ANCHORS}
    return {n: x for n, x in sets.items() if x}, [{k: r[k] for k in ("hash", "rule", "place", "term", "pattern")} for r in known]


def _literal(value: list, schema: str) -> Column:
    """A constant, which Spark's optimizer reads once."""
    return F.from_json(F.lit(json.dumps({"x": value})), f"struct<x:{schema}>")["x"]


def _among(grams: str, known: list[int]) -> Column:
    return F.filter(grams, lambda h: h.isin(known))


def _with_phrases(forms: DataFrame, rules: list[dict]) -> DataFrame:
    """forms (with __plain) and __hits: array<struct<rule, place, term, position>> of all phrases found, in order."""
    phrases = [(i, j, t) for i, rule in enumerate(rules) if rule["kind"] == "phrase" for j, t in enumerate(rule["groups"][0])]
    if not phrases:
        return forms
    sets, entries = _indexed(phrases)
    for name, grams in _grams("__plain", max(sets, default=1)).items():
        forms = forms.withColumn(name, grams)
    hashed = [e for e in entries if e["hash"] is not None]
    buckets = [[] for _ in range(1 << max(1, len(hashed)).bit_length())]
    for e in hashed:
        buckets[e["hash"] % len(buckets)].append(e)
    table = _literal(buckets, f"array<array<{ENTRY}>>")
    there = [_among(f"__grams{n}", known) for n, known in sets.items()]
    known = F.array_distinct(F.concat(*there)) if there else F.expr("cast(array() as array<long>)")

    def looked_up(h: Column) -> Column:
        return F.filter(F.get(table, F.pmod(h, F.lit(len(buckets))).cast("int")), lambda e: e["hash"] == h)

    wordless = _literal([e for e in entries if e["hash"] is None], f"array<{ENTRY}>")
    candidates = F.concat(F.flatten(F.transform("__known", looked_up)), wordless)
    text = F.col("__plain")
    found = F.filter(candidates, lambda e: F.regexp_like(text, e["pattern"]))
    places = F.transform(found, lambda e: F.struct(e["rule"], e["place"], e["term"], F.length(F.get(F.split(text, e["pattern"], 2), 0)).alias("position")))
    return forms.withColumn("__known", known).withColumn("__hits", F.array_sort(places)).drop("__known", *(f"__grams{n}" for n in ANCHORS))


def rule_matches(text: Column, rule: dict, number: int) -> Column:
    """array<struct<scenario, rule, kind, terms, position, excerpt>> of rule `number` in a text in plain form: one match for
    each phrase found (in __hits), or each window."""
    if rule["kind"] == "phrase":
        own = F.filter("__hits", lambda h: h["rule"] == number)
        found = F.transform(own, lambda h: F.struct(h["position"], F.array(h["term"]).alias("terms")))
    else:
        found = _windows(text, rule["groups"], rule["window"])
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(rule["scenario"]).alias("scenario"), F.lit(rule["rule"]).alias("rule"), F.lit(rule["kind"]).alias("kind"), m["terms"].alias("terms"), m["position"].alias("position"), excerpt(text, m["position"], m["position"]).alias("excerpt")
        ),
    )


def _searched(docs: DataFrame, rules: list[dict], text: str) -> DataFrame:
    """docs with their plain form and the phrases found in it, in columns that start with two underscores."""
    bound_batches(docs.sparkSession)
    return _with_phrases(docs.withColumn("__plain", plain(F.coalesce(text, F.lit("")))), rules)


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is computed once: Spark copies no expression, such as into a filter, through an explode."""
    return rows.select("*", F.explode(F.array(value)).alias(name)).drop("__plain", "__hits")


def inventory(docs: DataFrame, rules: list[dict], text: str = "text") -> DataFrame:
    """docs with `matches`: all matches of all rules, in order.  No row leaves its partition."""
    matches = F.concat(*(rule_matches(F.col("__plain"), r, i) for i, r in enumerate(rules)))
    return _once(_searched(docs, rules, text), "matches", matches)


def check(docs: DataFrame, rules: list[dict], text: str = "text") -> DataFrame:
    """docs with `match`: the first match of the first rule that has one; null for clean documents."""
    firsts = [F.get(rule_matches(F.col("__plain"), r, i), 0) for i, r in enumerate(rules)]
    return _once(_searched(docs, rules, text), "match", F.coalesce(*firsts))


def described(match: Column) -> Column:
    """A match in a line, for events and reports."""
    terms = F.concat(F.lit("["), F.array_join(F.transform(match["terms"], lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "), F.lit("]"))
    return F.concat(F.lit("contamination ["), match["scenario"], F.lit("/"), match["rule"], F.lit("] terms="), terms, F.lit(" @"), match["position"].cast("string"), F.lit(": « "), match["excerpt"], F.lit(" »"))


def rules_described(rules: list[dict]) -> str:
    scenarios = list(dict.fromkeys(r["scenario"] for r in rules))
    return f"{len(rules)} rules over {len(scenarios)} scenario(s): {', '.join(scenarios)}"


def audit(corpora: dict[str, DataFrame], rules: list[dict], key: str = "id") -> DataFrame:
    """corpus, key and fields of every match in several corpora; rows mean that the audit failed."""
    out = None
    for name, docs in corpora.items():
        own = inventory(docs, rules).select(F.lit(name).alias("corpus"), key, F.explode("matches").alias("m")).select("corpus", key, "m.*")
        out = own if out is None else out.unionByName(own)
    return out


@dataclass
class Audit:
    """The state of each corpus (corpus, n_records, n_flagged, state), all matches, and whether none was found."""

    states: DataFrame
    matches: DataFrame
    passed: bool

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 1


def audited(corpora: dict[str, DataFrame | None], rules: list[dict], key: str = "id") -> Audit:
    """The verdict on several corpora.  One that is None is missing: it is listed, and does not fail the audit."""
    there = {k: v for k, v in corpora.items() if v is not None}
    spark = SparkSession.getActiveSession()
    missing = spark.createDataFrame([(k, 0, 0, "missing") for k, v in corpora.items() if v is None], "corpus string, n_records long, n_flagged long, state string")
    if not there:
        return Audit(missing, spark.createDataFrame([], f"corpus string, {key} string"), True)
    matches = shared_table(audit(there, rules, key), "audit")
    sizes = None
    for name, docs in there.items():
        own = docs.agg(F.count("*").alias("n_records")).select(F.lit(name).alias("corpus"), "n_records")
        sizes = own if sizes is None else sizes.unionByName(own)
    flagged = matches.select("corpus", key).distinct().groupBy("corpus").agg(F.count("*").alias("n_flagged"))
    states = sizes.join(flagged, "corpus", "left").withColumn("n_flagged", F.coalesce("n_flagged", F.lit(0)))
    states = states.withColumn("state", F.when(F.col("n_flagged") > 0, "CONTAMINATED").otherwise("clean"))
    return Audit(states.unionByName(missing), matches, matches.isEmpty())


def text_audited(spark: SparkSession, text: str, rules: list[dict]) -> Audit:
    """The verdict on one string."""
    return audited({"text": spark.createDataFrame([("text", text)], "id string, text string")}, rules)
