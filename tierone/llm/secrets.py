"""Secret scans by a trigram inverted index (DataFrame functions only).

Each rule's regex is read for the trigrams that any match must contain, which
gives a Boolean query: some branch, all of whose trigrams are present. The
index stores postings (trigram, document) for the trigrams of all queries;
a query intersects its trigrams' postings and joins its branches. Only the
documents it leaves are verified with the regex itself; rules without
mandatory trigrams scan every document.

Positions are code points of the whole text, end exclusive, leftmost and not
overlapping within a kind. They follow from splitting the text at the matches:
a match begins where the parts and matches before it end.

Defined results: null text counts as empty; documents are told apart by
``doc_id`` and text in the index and row by row in the scan, so repeated rows
each get all their spans; an empty table gives no rows.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierone.llm.common import join_checked, let, materialize


class Rule(NamedTuple):
    kind: str
    regex: str
    group: int = 0          # the group whose length counts
    least: int = 1          # its least length
    base: bool = False


#: The base kinds in the order spans list them.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]+", 0, 16, True),
]
#: Public formats of issued keys.
FORMAT_RULES = [
    Rule("aws_temporary", r"ASIA[A-Z0-9]{16}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]{82}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,64}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{40,60}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("google_oauth", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,128}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("mailgun", r"key-[0-9a-f]{32}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{50,}"),
    Rule("huggingface", r"hf_[A-Za-z0-9]{34}"),
    Rule("openai", r"sk-(?:proj-)?[A-Za-z0-9_-]{32,}"),
    Rule("digitalocean", r"do[opr]_v1_[0-9a-f]{64}"),
    Rule("shopify", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    Rule("square", r"sq0(?:atp|csp)-[A-Za-z0-9_-]{22,43}"),
    Rule("telegram", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("azure_storage", r"AccountKey=[A-Za-z0-9+/]{86}=="),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP |ENCRYPTED )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("bearer", r"(?i:authorization)\x20?:\x20?(?i:bearer)\x20[A-Za-z0-9._~+/=-]{16,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{3,128}@"),
    Rule("aws_secret", r"(?i:aws_secret_access_key)[\x22']?\x20?[=:]\x20?[\x22']?[A-Za-z0-9/+]{40}"),
]
RULES = BASE_RULES + FORMAT_RULES
BRANCH_TRIGRAMS = 4
#: Most branches a regex may open before the text so far is closed.
MAX_BRANCHES = 64


def trigram_query(regex: str) -> list[list[str]] | None:
    """Branches of trigrams (lower case): a match contains all of some branch; None: no bound.

    A branch is a pair of the trigrams found and the literal run being read.
    """

    def close(branches: list) -> list:
        return [(found | {run[i:i + 3] for i in range(len(run) - 2)}, "") for found, run in branches]

    def read(items, branches: list) -> list:
        for op, arg in items:
            choices = None
            if op is C.LITERAL:
                choices = {chr(arg).lower()}
            elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
                choices = {chr(a).lower() for _, a in arg}
            if choices is not None and len(branches) * len(choices) <= MAX_BRANCHES:
                branches = [(found, run + c) for found, run in branches for c in sorted(choices)]
            elif op is C.SUBPATTERN:
                branches = read(arg[3], branches)
            elif op is C.BRANCH and len(branches) * len(arg[1]) <= MAX_BRANCHES:
                branches = [b for part in arg[1] for b in read(part, branches)]
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, part = arg
                if (low, high) == (0, 1) and 2 * len(branches) <= MAX_BRANCHES:
                    branches = branches + read(part, branches)
                elif low:
                    branches = close(read(part, branches) if low == 1 else read(part, close(branches)))
                else:
                    branches = close(branches)
            elif op in (C.AT, C.ASSERT_NOT):
                continue
            else:
                branches = close(branches)
        return branches

    found = {frozenset(f) for f, _ in close(read(parser.parse(regex), [(frozenset(), "")]))}
    if not all(found):
        return None
    # A few trigrams per branch are enough to verify little; those beyond plain letters are rarest.
    few = {frozenset(sorted(f, key=lambda t: (t.isalpha(), t))[:BRANCH_TRIGRAMS]) for f in found}
    return sorted(sorted(f) for f in few if not any(g < f for g in few))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def build_index(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Postings ``tri, doc_id, key`` for every trigram that the rules' queries name."""
    named = sorted({t for r in rules for branch in trigram_query(r.regex) or [] for t in branch})
    low = docs.select("doc_id", text_key(F.col("text")).alias("key"),
                      F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    trigrams = F.array(*[F.lit(t) for t in named])
    present = let(F.col("low"), lambda low: F.filter(trigrams, lambda t: F.contains(low, t)))
    return materialize(low.select("doc_id", "key", F.explode(present).alias("tri")), "secret-index")


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id, key, kinds``: the indexed rules whose query each document satisfies."""
    query = [(t, r.kind, b, len(branch)) for r in rules
             for b, branch in enumerate(trigram_query(r.regex) or []) for t in branch]
    terms = index.sparkSession.createDataFrame(query, "tri string, kind string, branch int, need int")
    return (index.distinct().join(F.broadcast(terms), "tri")
            .groupBy("doc_id", "key", "kind", "branch", "need").agg(F.count(F.lit(1)).alias("have"))
            .filter("have = need").groupBy("doc_id", "key")
            .agg(F.collect_set("kind").alias("kinds")))


def found_in(text: Column, rule: Rule) -> Column:
    """Matches of one rule: (kind, place, length before it, length, whether it passes)."""
    def all_of(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(rule.regex), F.lit(group))

    lists = [all_of(0).alias("m"), F.split(text, rule.regex, -1).alias("part")]
    if rule.group:
        lists.append(all_of(rule.group).alias("g"))
    # There is one part more than matches.
    rows = F.filter(F.arrays_zip(*lists), lambda x: x["m"].isNotNull())
    return F.transform(rows, lambda x, i: F.struct(
        F.lit(rule.kind).alias("kind"), i.alias("i"), F.char_length(x["part"]).alias("gap"),
        F.char_length(x["m"]).alias("len"),
        (F.char_length(x["g" if rule.group else "m"]) >= rule.least).alias("good")))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: rid, doc_id and ``spans``, the (kind, start, end) found."""
    index = build_index(docs, rules)
    chosen = materialize(candidates(index, rules), "secret-candidates")
    text = F.col("body")
    rows = join_checked(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
                        .withColumn("key", text_key(text)), chosen, ["doc_id", "key"])
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,len:int,good:boolean>>")
    scanned = []
    for rule in rules:
        if trigram_query(rule.regex) is None:
            # A full scan looks for a match long enough before it takes the text apart.
            wanted = F.rlike(text, F.lit(long_enough(rule)))
        else:
            wanted = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        scanned.append(F.when(wanted, found_in(text, rule)).otherwise(none))
    table = materialize(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                                    F.concat(*scanned).alias("found")), "secret-found")
    order = Window.partitionBy("rid", "kind").orderBy("i")
    place = {r.kind: n for n, r in enumerate(rules)}
    rank = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    spans = (table.select("rid", F.explode("found").alias("x")).select("rid", "x.*")
             .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order))
             .filter("good")
             .select("rid", F.struct((F.col("end") - F.col("len")).alias("start"),
                                     rank[F.col("kind")].alias("rank"), "kind", "end").alias("s"))
             .groupBy("rid").agg(F.array_sort(F.collect_list("s")).alias("spans")))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return (table.select("rid", "doc_id").join(spans, "rid", "left")
            .withColumn("spans", F.coalesce("spans", empty)))


def long_enough(rule: Rule) -> str:
    """The regex of a rule that ends in a repeat, with its least length as the bound."""
    if rule.least > 1 and rule.group == 0 and rule.regex.endswith("]+"):
        return rule.regex[:-1] + f"{{{rule.least},}}"
    return rule.regex


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Counts and digest of the base kinds and the list of all spans, per document."""
    base = [r.kind for r in rules if r.base]
    only = F.filter("spans", lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in base]
    return scanned.select("doc_id", *counts, F.sha2(joined(only), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"))
