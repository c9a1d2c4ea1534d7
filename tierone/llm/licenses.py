"""License scans by ordered signature rules (DataFrame functions only).

Texts are brought to a normal form, their words in lower case between single
spaces, in which rules match whole words. Each rule names one keyword that its
regex cannot match without; a document is tested for each keyword once, and
only rules whose keyword it has are run. A detection is an interval of words
with its rule's priority. One that lies inside another of the same or a better
priority is suppressed (equal intervals: the better priority, then the earlier
rule, stays); base detections are counted before suppression and always keep
their labels. The score is the best confidence among what stays.

Rules by priority: 0 sentences of license texts, 1 grants ("licensed under
X"), 2 tags ("license: X"), 3 plain mentions, 4 base phrases. All but the
sentences come from the table of names below.

Defined results: null text has no words, no labels and score 0; repeated rows
are scanned one by one; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierone.llm.common import ascii_lower, materialize, words_of

#: label, keyword, name in normal form (a regex over words)
NAMES = [
    ("mit", "mit", r"mit(?: x11)?"),
    ("mit-0", "mit", r"mit 0|mit no attribution"),
    ("isc", "isc", r"isc"),
    ("x11", "x11", r"x11"),
    ("0bsd", "0bsd", r"0bsd|bsd zero clause"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause|4 clause bsd|original bsd"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)?(?: 2 0| 2|v2| v2)"),
    ("apache", "apache", r"apache(?: software)?"),
    ("gpl-1.0", "general", r"gnu general public license(?: version| v)? 1(?: 0)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public license(?: version| v)?(?: 2 0| 2| v2)"),
    ("gpl-3.0", "general", r"(?:gnu )?general public license(?: version| v)?(?: 3 0| 3| v3)"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: version| v)?(?: 2 0| 2| v2)(?: only| or later)?"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: version| v)?(?: 3 0| 3| v3)(?: only| or later)?"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl", "general", r"(?:gnu )?general public license"),
    ("lgpl-2.0", "lgpl", r"(?:gnu )?lgpl(?: version| v)?(?: 2 0| 2)"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version| v)?(?: 2 1| v2 1)"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl(?: version| v)?(?: 3 0| 3| v3)"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public license"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: version| v)?(?: 3 0| 3| v3)"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version| v)?(?: 3 0| 3| v3)"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation license(?: version)? 1 3"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license"),
    ("gfdl", "gfdl", r"gfdl"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? 2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("mpl-2.0", "mpl", r"mpl(?: version| v)? 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? 1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? 2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    ("epl-2.0", "epl", r"epl 2 0"),
    ("edl-1.0", "eclipse", r"eclipse distribution license"),
    ("cddl-1.0", "cddl", r"cddl(?: version)?(?: 1 0)?"),
    ("cddl-1.0", "development", r"common development and distribution license"),
    ("cpl-1.0", "common", r"common public license"),
    ("eupl-1.2", "eupl", r"eupl(?: version| v)?(?: 1 2)?"),
    ("eupl-1.2", "european", r"european union public licen[cs]e"),
    ("artistic-2.0", "artistic", r"artistic license 2 0"),
    ("artistic", "artistic", r"artistic"),
    ("bsl-1.0", "boost", r"boost software(?: license)?"),
    ("busl-1.1", "business", r"business source license"),
    ("sspl-1.0", "sspl", r"sspl(?: version)?(?: 1 0)?"),
    ("sspl-1.0", "server", r"server side public license"),
    ("elastic-2.0", "elastic", r"elastic license(?: 2 0)?"),
    ("zlib", "zlib", r"zlib"),
    ("libpng", "libpng", r"libpng"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("python-2.0", "psf", r"psf"),
    ("python-2.0", "python", r"python software foundation"),
    ("php-3.0", "php", r"php"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl(?: 1 1)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("cecill-2.1", "cecill", r"cecill(?: 2 1)?"),
    ("ecl-2.0", "educational", r"educational community license"),
    ("afl-3.0", "academic", r"academic free license"),
    ("osl-3.0", "open", r"open software license"),
    ("upl-1.0", "universal", r"universal permissive license"),
    ("vim", "vim", r"vim"),
    ("curl", "curl", r"curl"),
    ("odbl-1.0", "database", r"open database license|odbl"),
    ("odc-by-1.0", "attribution", r"open data commons attribution"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by", "commons", r"creative commons attribution"),
    ("cc", "commons", r"creative commons"),
    ("openrail", "openrail", r"(?:bigscience )?openrail(?: m)?"),
    ("llama", "llama", r"llama(?: [23])? community"),
    ("proprietary", "proprietary", r"proprietary"),
]
#: Names too plain to count alone: a mention needs "license" after them.
NEEDS_WORD = {"mit", "isc", "x11", "bsd", "apache", "artistic", "zlib", "libpng", "postgresql",
              "php", "ruby", "openssl", "vim", "curl", "proprietary", "python-2.0", "ncsa", "llama"}
#: label, keyword, sentence of a license's text in normal form
SENTENCES = [
    ("mit", "granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache", r"(?:http|https) www apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", "perpetual", r"hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-2.0-or-later", "option", r"either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "option", r"either version 3 of the license or at your option any later version"),
    ("gpl", "gnu", r"(?:http|https) www gnu org licenses gpl(?: [23] 0)?(?: html| txt)?"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "mozilla", r"(?:http|https) (?:www )?mozilla org mpl 2 0"),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public license v?(?: ?2 0)?"),
    ("bsl-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", r"(?:released into|dedicated to|placed in|in) the public domain"),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license version 1 1"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license"),
    ("as-is", "warranty", r"without warranty of any kind"),
    ("as-is", "warranties", r"without warranties or conditions of any kind"),
    ("all-rights-reserved", "reserved", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?"),
]
#: The phrases counted as base.
BASE = [("mit", "license", "mit license"), ("apache", "license", "apache license"),
        ("gpl", "license", "general public license")]

GRANT = (r"(?:licensed|released|distributed|available|provided|published|redistributed|covered|shared) "
         r"under (?:the )?(?:terms of )?(?:the )?(?:{name})(?: licen[cs]e)?(?: version [0-9])?")
TAG = r"(?:spdx license identifier|licen[cs]e|licen[cs]es|licen[cs]ed) (?:is )?(?:the )?(?:{name})"
CONFIDENCE = (1.0, 0.95, 0.85, 0.7, 0.6)


class Rule(NamedTuple):
    rule: int
    label: str
    keyword: str
    regex: str
    priority: int


def rule_table() -> list[Rule]:
    listed = [(label, kw, text, 0) for label, kw, text in SENTENCES]
    listed += [(label, kw, GRANT.format(name=name), 1) for label, kw, name in NAMES]
    listed += [(label, kw, TAG.format(name=name), 2) for label, kw, name in NAMES]
    listed += [(label, kw, rf"(?:{name})" + (" licen[cs]e" if label in NEEDS_WORD else "(?: licen[cs]e)?"), 3)
               for label, kw, name in NAMES]
    listed += [(label, kw, phrase, 4) for label, kw, phrase in BASE]
    return [Rule(i, label, kw, rf"(?<= )(?:{regex})(?= )", p)
            for i, (label, kw, regex, p) in enumerate(listed)]


def prepared(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """rid, doc_id, n_words, the keywords present and, if there are any, the normal form."""
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    low = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                      ascii_lower(F.coalesce("text", F.lit(""))).alias("low"))
    found = low.select("rid", "doc_id", words_of(F.col("low")).alias("words"),
                       F.filter(keywords, lambda k: F.contains(F.col("low"), k)).alias("keywords"))
    form = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    return found.select("rid", "doc_id", F.size("words").cast("long").alias("n_words"), "keywords",
                        F.when(F.size("keywords") > 0, form).alias("form"))


def detections(prep: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rid, rule, label, priority, start, end`` of every match, in words, end exclusive."""
    table = prep.sparkSession.createDataFrame(
        rules, "rule int, label string, keyword string, regex string, priority int")
    rows = (prep.select("rid", "form", F.explode("keywords").alias("keyword"))
            .join(F.broadcast(table), "keyword").filter(F.rlike("form", F.col("regex"))))

    def gaps(x):                        # words begin after spaces
        return F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))

    # There is one part more than matches.
    pairs = F.arrays_zip(F.regexp_extract_all("form", "regex", F.lit(0)).alias("m"),
                         F.split("form", F.col("regex"), -1).alias("part"))
    found = F.transform(F.filter(pairs, lambda x: x["m"].isNotNull()), lambda x, i: F.struct(
        i.alias("i"), gaps(x["part"]).alias("gap"), gaps(x["m"]).alias("inner")))
    order = Window.partitionBy("rid", "rule").orderBy("i")
    begin = F.sum(F.col("gap") + F.col("inner")).over(order) - F.col("inner") - 1
    return (rows.select("rid", "rule", "label", "priority", F.explode(found).alias("m"))
            .select("rid", "rule", "label", "priority", "m.*")
            .withColumn("start", begin)
            .select("rid", "rule", "label", "priority", "start",
                    (F.col("start") + F.col("inner") + 1).alias("end")))


def suppressed(found: DataFrame, priorities: int = len(CONFIDENCE)) -> DataFrame:
    """``found`` with ``inside``: contained in another of the same or a better priority.

    Intervals that begin earlier, or here but end later, come first; the
    farthest end among them, by priority, tells whether one contains this.
    """
    order = (Window.partitionBy("rid").orderBy("start", F.col("end").desc(), "priority", "rule")
             .rowsBetween(Window.unboundedPreceding, -1))
    inside = F.lit(False)
    for p in range(priorities):
        reach = F.max(F.when(F.col("priority") <= p, F.col("end"))).over(order)
        inside = F.when(F.col("priority") == p, F.coalesce(reach >= F.col("end"), F.lit(False))).otherwise(inside)
    return found.withColumn("inside", inside)


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: rid, doc_id, n_words, base counts, labels and score."""
    rules = rules or rule_table()
    prep = materialize(prepared(docs, rules), "license-prepared")
    found = suppressed(detections(prep, rules))
    confidence = F.array(*[F.lit(c) for c in CONFIDENCE])[F.col("priority")]
    base = F.col("priority") == len(CONFIDENCE) - 1
    stays = base | ~F.col("inside")
    names = F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",")
    per_doc = found.groupBy("rid").agg(
        F.count(F.when(base, F.lit(1))).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names.alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(stays, F.col("label")))), ",").alias("labels"),
        F.max(F.when(stays, confidence)).alias("score"),
        F.count(F.when(stays, F.lit(1))).alias("n_detections"))
    none = F.lit("")
    return (prep.select("rid", "doc_id", "n_words").join(per_doc, "rid", "left")
            .select("rid", "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
                    "first_word", "last_word", F.coalesce("base_labels", none).alias("base_labels"),
                    F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
                    F.coalesce("n_detections", F.lit(0).cast("long")).alias("n_detections")))
