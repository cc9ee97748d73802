"""License detections by ordered signature rules.

A rule is a pattern over a text's normalised words, with a label, a priority and
a keyword that every match contains.  Rules are license names within phrase templates, and
hand-written ones for what names a license without such a phrase.  Per text: one gate that few texts pass, then only the rules
whose keyword occurs; of their matches, one that lies inside a match of the same
or a higher priority is dropped.  All of it is expressions over one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import NOT_ALNUM, ascii_lower

# Phrases of the base labels, as normalised words.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Labels, and the names they go by as patterns of normalised words.
NAMES = (
    ("mit", "mit"), ("mit", "expat"), ("mit", "x11"), ("isc", "isc"), ("zlib", "zlib"),
    ("apache-1.1", "apache(?: software)?(?: version)? 1 1"), ("apache-2", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"), ("apache", "apache"),
    ("bsd-2", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)"), ("bsd-3", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4", "(?:original bsd|bsd 4 clause|4 clause bsd)"), ("bsd-0", "(?:0bsd|zero clause bsd)"), ("bsd", "bsd"),
    ("gpl-1", "(?:gpl|gnu general public license)(?: version| v)? 1(?: 0)?"), ("gpl-2", "(?:gpl|gpl v2|gplv2|gnu general public license)(?: version| v)? 2(?: 0)?"),
    ("gpl-2", "(?:gplv2|gpl v2|gnu general public license v2)(?: 0)?"), ("gpl-3", "(?:gplv3|gpl v3|gnu general public license v3)(?: 0)?"),
    ("gpl-3", "(?:gpl|gpl v3|gplv3|gnu general public license)(?: version| v)? 3(?: 0)?"), ("gpl", "(?:gpl|gnu general public license)"),
    ("lgpl-2.1", "(?:lgpl|gnu lesser general public license)(?: version| v)? 2 1"), ("lgpl-3", "(?:lgpl|gnu lesser general public license)(?: version| v)? 3(?: 0)?"),
    ("lgpl", "(?:lgpl|gnu (?:lesser|library) general public license)"), ("agpl-3", "(?:agpl|gnu affero general public license)(?: version| v)? 3(?: 0)?"),
    ("agpl", "(?:agpl|gnu affero general public license)"), ("fdl-1.3", "(?:gfdl|gnu free documentation license)(?: version| v)? 1 3"), ("fdl", "(?:gfdl|gnu free documentation license)"),
    ("mpl-1.1", "(?:mpl|mozilla public license)(?: version| v)? 1 1"), ("mpl-2", "(?:mpl|mozilla public license)(?: version| v)? 2(?: 0)?"), ("mpl", "(?:mpl|mozilla public license)"),
    ("epl-1", "(?:epl|eclipse public license)(?: version| v)? 1(?: 0)?"), ("epl-2", "(?:epl|eclipse public license)(?: version| v)? 2(?: 0)?"), ("epl", "(?:epl|eclipse public license)"),
    ("cddl-1", "(?:cddl|common development and distribution license)(?: version| v)?(?: 1(?: 0)?)?"), ("cpl-1", "common public license(?: version)?(?: 1(?: 0)?)?"),
    ("eupl-1.2", "(?:eupl|european union public licence)(?: version| v)? 1 2"), ("eupl", "(?:eupl|european union public licence)"),
    ("artistic-2", "artistic(?: license)? 2(?: 0)?"), ("artistic", "artistic"), ("perl", "perl 5"), ("python-2", "(?:python software foundation|psf)"), ("ruby", "ruby"), ("php-3", "php"),
    ("postgresql", "postgresql"), ("openssl", "openssl"), ("curl", "curl"), ("ncsa", "(?:ncsa|university of illinois ncsa)"), ("w3c", "w3c(?: software)?"), ("boost-1", "boost(?: software)?(?: license)?(?: 1 0)?"),
    ("unlicense", "unlicense"), ("wtfpl", "(?:wtfpl|do what the fuck you want to public license)"), ("zpl-2", "(?:zpl|zope public license)"), ("ofl-1.1", "(?:ofl|sil open font license)(?: 1 1)?"),
    ("odbl-1", "(?:odbl|open database license)"), ("pddl-1", "(?:pddl|open data commons public domain dedication)"), ("bsl-1.1", "business source license(?: 1 1)?"), ("sspl-1", "(?:sspl|server side public license)"),
    ("elastic-2", "elastic(?: license)? 2(?: 0)?"), ("ms-pl", "(?:ms pl|microsoft public license)"), ("ms-rl", "(?:ms rl|microsoft reciprocal license)"), ("afl-3", "(?:afl|academic free license)(?: 3 0)?"),
    ("osl-3", "(?:osl|open software license)(?: 3 0)?"), ("cecill", "cecill"), ("ijg", "independent jpeg group"), ("vim", "vim"), ("upl-1", "universal permissive license"), ("blueoak-1", "blue oak model license"),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|no derivatives)"),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)"), ("cc-by-nd", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|no derivatives)"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)"), ("cc-by", "(?:cc by|creative commons attribution)"), ("cc0", "(?:cc0|creative commons zero)"),
)

# Templates as (priority, weight, keyword, pattern around the name); the least number ranks first.
TEMPLATES = (
    (0, 1.0, "spdx license identifier", "spdx license identifier {name}(?: only| or later)?"),
    (1, 0.95, "ed under", "licen[cs]ed under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?(?: version \\d+)?(?: \\d+)?"),
    (1, 0.9, " under", "(?:released|distributed|published|available|provided|covered|used) under (?:the )?(?:terms of (?:the )?)?{name} licen[cs]e(?: version \\d+)?(?: \\d+)?"),
    (2, 0.7, " licen", "{name} (?:public )?licen[cs]e(?: version \\d+)?(?: \\d+)?"),
    (2, 0.6, " licen", "licen[cs]e (?:is |the )?{name}(?: \\d+)?"),
)

# Rules that need no license name, as (label, weight, pattern); each contains its first word.
PLAIN = (
    ("cc", 0.6, "creative commons(?: licen[cs]e)?"),
    ("public-domain", 0.7, "(?:dedicated to|released into|placed in|in) the public domain"),
    ("proprietary", 0.5, "all rights reserved"),
    ("copyright", 0.3, "copyright (?:c )?(?:19|20)\\d\\d"),
)
PLAIN_KEYWORDS = {"cc": "creative commons", "public-domain": "public domain", "proprietary": "all rights reserved", "copyright": "copyright"}

# Names that stand alone, as (label, weight, keyword, pattern); every match contains the keyword.
HAND = (
    ("agpl", 0.6, " agpl ", "(?:gnu )?agpl"),
    ("agpl", 0.6, "affero general public licen", "(?:gnu )?affero general public licen[cs]e"),
    ("agpl-3", 0.8, " agpl", "(?:gnu )?agpl(?: version| ?v)? ?3(?: 0)?(?: only| or later)?"),
    ("agpl-3", 0.8, "affero general public licen", "(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?(?: or (?:any )?later(?: version)?)?"),
    ("apache-1.1", 0.8, " apache", "apache(?: software)?(?: licen[cs]e)?(?: version| v)? 1 1"),
    ("apache-2", 0.8, " apache", "apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?2 0"),
    ("apache-2", 0.7, " asl", "asl(?: version| ?v)? ?2(?: 0)?"),
    ("apache-2", 0.8, "apache org licenses licen", "apache org licenses licen[cs]e 2 0"),
    ("artistic-2", 0.8, "artistic licen", "(?:the )?artistic licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("bsd-0", 0.8, "bsd", "(?:0bsd|bsd zero clause|zero clause bsd)"),
    ("bsd-2", 0.8, "bsd", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)"),
    ("bsd-3", 0.8, "bsd", "(?:bsd 3 clause|3 clause bsd|three clause bsd|modified bsd|revised bsd)"),
    ("bsd-4", 0.8, "bsd", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)"),
    ("bsl-1.1", 0.7, "business source licen", "business source licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("boost-1", 0.8, "boost software licen", "boost software licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cc-by", 0.6, "creativecommons org licenses by ", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-nc", 0.6, "creativecommons org licenses by nc", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-nd", 0.6, "creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", 0.6, "creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nd", 0.6, "creativecommons org licenses by nd", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-sa", 0.6, "creativecommons org licenses by sa", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc0", 0.7, " cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 0.7, "creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cddl-1", 0.7, "common development and distribution licen", "common development and distribution licen[cs]e(?: version| v)?(?: 1 [01])?"),
    ("cddl-1", 0.7, " cddl", "cddl(?: version| ?v)? ?1(?: [01])?"),
    ("epl", 0.6, "eclipse public licen", "eclipse public licen[cs]e"),
    ("epl-1", 0.8, "eclipse public licen", "eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2", 0.8, "eclipse public licen", "eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("eupl", 0.6, "european union public licen", "european union public licen[cs]e"),
    ("eupl-1.2", 0.8, "european union public licen", "european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl-1.2", 0.8, " eupl", "eupl(?: version| ?v)? ?1 2"),
    ("fdl", 0.6, "free documentation licen", "(?:gnu )?free documentation licen[cs]e"),
    ("fdl-1.3", 0.8, "free documentation licen", "(?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 3"),
    ("gpl", 0.6, " gpl ", "(?:gnu )?gpl"),
    ("gpl", 0.6, "general public licen", "(?:gnu )?general public licen[cs]e"),
    ("gpl-2", 0.8, " gpl", "(?:gnu )?gpl(?: version| ?v)? ?2(?: 0)?(?: only| or later)?"),
    ("gpl-2", 0.8, "general public licen", "(?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)?(?: or (?:any )?later(?: version)?)?"),
    ("gpl-3", 0.8, " gpl", "(?:gnu )?gpl(?: version| ?v)? ?3(?: 0)?(?: only| or later)?"),
    ("gpl-3", 0.8, "general public licen", "(?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)?(?: or (?:any )?later(?: version)?)?"),
    ("isc", 0.7, "released under ", "released under (?:the )?(?:terms of (?:the )?)?isc"),
    ("lgpl", 0.6, " lgpl ", "(?:gnu )?lgpl"),
    ("lgpl", 0.6, "er general public licen", "(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-2.1", 0.8, " lgpl", "(?:gnu )?lgpl(?: version| ?v)? ?2 1(?: only| or later)?"),
    ("lgpl-2.1", 0.8, "er general public licen", "(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1"),
    ("lgpl-3", 0.8, " lgpl", "(?:gnu )?lgpl(?: version| ?v)? ?3(?: 0)?(?: only| or later)?"),
    ("lgpl-3", 0.8, "er general public licen", "(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("mit", 0.7, "released under ", "released under (?:the )?(?:terms of (?:the )?)?mit"),
    ("mit", 0.7, "distributed under ", "distributed under (?:the )?(?:terms of (?:the )?)?mit"),
    ("mit", 0.7, "available under ", "available under (?:the )?(?:terms of (?:the )?)?mit"),
    ("mit", 0.8, "opensource org licenses mit", "opensource org licenses mit"),
    ("mit", 0.6, "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", 0.6, "mozilla public licen", "mozilla public licen[cs]e"),
    ("mpl-1.1", 0.8, "mozilla public licen", "mozilla public licen[cs]e(?: version| v)? ?1 1"),
    ("mpl-2", 0.8, "mozilla public licen", "mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl-2", 0.8, " mpl", "mpl(?: version| ?v)? ?2(?: 0)?"),
    ("ms-pl", 0.7, "microsoft public licen", "microsoft public licen[cs]e"),
    ("odbl-1", 0.7, "open database licen", "open database licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("ofl-1.1", 0.7, "open font licen", "(?:sil )?open font licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("python-2", 0.7, "python ", "python(?: software foundation)? licen[cs]e(?: version| v)?(?: 2(?: 0)?)?"),
    ("sspl-1", 0.7, "server side public licen", "server side public licen[cs]e(?: version| v)?(?: 1(?: 0)?)?"),
    ("unlicense", 0.7, "unlicen", "(?:the )?unlicen[cs]e"),
    ("zpl-2", 0.7, "zope public licen", "zope public licen[cs]e(?: version| v)?(?: 2 [01])?"),
)
LEVELS = 4
# Every match of every rule contains one of these.
GATE = (
    "licen", "public domain", "creative commons", "all rights reserved", "copyright", "cc by", "creativecommons org", " cc0", " apache", " asl", "bsd",
    " gpl", " agpl", " lgpl", " mpl", " cddl", " eupl", "released under ", "distributed under ", "available under ", "permission is hereby granted",
)


def literals(name: str) -> list[str]:
    """What a name's pattern begins with: one of these is in every match."""
    options = name[3 : name.index(")")].split("|") if name.startswith("(?:") else [name]
    return [" " + option.split("(?:")[0].rstrip("?") for option in options]


def rules() -> list[tuple[str, int, float, str, str, list[str]]]:
    """``label, priority, weight, keyword, pattern, literals`` in order of priority."""
    made = [
        (label, priority, weight, keyword, template.replace("{name}", name), literals(name))
        for priority, weight, keyword, template in TEMPLATES
        for label, name in NAMES
    ]
    made += [(label, LEVELS - 1, weight, PLAIN_KEYWORDS[label], pattern, [""]) for label, weight, pattern in PLAIN]
    made += [(label, 2, weight, keyword, pattern, [""]) for label, weight, keyword, pattern in HAND]
    return sorted(made, key=lambda r: r[1])


def rule_array(entries) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(number).alias("rule"), F.lit(weight).alias("weight"),
                F.lit(keyword).alias("keyword"), F.array(*map(F.lit, names)).alias("names"), F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"),
            )
            for number, (label, priority, weight, keyword, pattern, names) in enumerate(entries)
        ]
    )


def base_rules() -> list[tuple[str, int, float, str, str, list[str]]]:
    for phrase, _ in BASE:
        w = phrase.split()
        if any(w[:n] == w[-n:] for n in range(1, len(w))):
            raise ValueError(f"{phrase!r}: a phrase that overlaps itself cannot be counted by a pattern")
    return [(label, 0, 0.9, f" {phrase} ", phrase, [""]) for phrase, label in BASE]


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


SPAN = "struct<start:int,end:int,priority:int,rule:int,label:string,weight:double>"


def spans(padded: str, rule: Column) -> Column:
    """Places of a rule's matches, counted in words; the text has a space before every word."""
    pieces = F.split(F.col(padded), rule["pattern"], -1)
    matches = F.regexp_extract_all(padded, rule["pattern"], F.lit(0))
    pairs = F.zip_with(matches, pieces, lambda m, p: F.struct(m.alias("match"), _spaces(p).alias("gap")))
    pairs = F.filter(pairs, lambda x: x["match"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        first = (acc["at"] + x["gap"]).cast("int")
        inside = _spaces(x["match"])
        span = F.struct(
            (first - 1).alias("start"), (first + inside).cast("int").alias("end"), rule["priority"].alias("priority"),
            rule["rule"].alias("rule"), rule["label"].alias("label"), rule["weight"].alias("weight"),
        )
        return F.struct((first + inside).cast("int").alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    return F.aggregate(pairs, start, step)["found"]


def scan(padded: str, entries) -> Column:
    """All matches of the rules whose keyword and name the text contains."""
    text = F.col(padded)
    possible = F.filter(
        rule_array(entries),
        lambda r: F.contains(text, r["keyword"])
        & F.exists(r["names"], lambda n: F.contains(text, n))
        & F.rlike(text, r["pattern"]),
    )
    return F.flatten(F.transform(possible, lambda r: spans(padded, r)))


def outermost(found: str) -> Column:
    """Matches not inside another one of the same or a higher priority.

    In order of start, longest first, what could contain a match comes before it,
    so the furthest end so far of each priority decides.  Equal matches keep the
    higher priority, then the rule that is listed first.
    """
    order = F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["priority"].alias("priority"), s["rule"].alias("rule"), s["label"].alias("label"), s["weight"].alias("weight")),
    )
    zero = F.struct(F.array(*[F.lit(0)] * LEVELS).alias("ends"), F.array().cast(f"array<{SPAN}>").alias("kept"))

    def step(acc: Column, s: Column) -> Column:
        end = -s["minus"]
        inside = F.array_max(F.slice(acc["ends"], 1, s["priority"] + 1)) >= end
        span = F.struct(s["start"].alias("start"), end.alias("end"), s["priority"].alias("priority"), s["rule"].alias("rule"), s["label"].alias("label"), s["weight"].alias("weight"))
        ends = F.transform(acc["ends"], lambda e, p: F.when((p == s["priority"]) & (e < end), end).otherwise(e))
        return F.struct(
            F.when(inside, acc["ends"]).otherwise(ends).alias("ends"),
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(span))).alias("kept"),
        )

    return F.aggregate(F.array_sort(order), zero, step)["kept"]


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, base, detections`` and the digest of them, one row per row of ``docs``.

    ``base`` and ``detections`` are arrays of spans in words with label, priority
    and weight.  ``score`` is the greatest weight found, 0 without a find.  A null
    text is empty.  Rows are scanned one by one: ids may be null or repeat, and
    other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    joined = F.trim(F.regexp_replace(ascii_lower(text), NOT_ALNUM, " "))
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.concat(F.lit(" "), joined, F.lit(" ")).alias("padded"))
    n_words = F.when(F.col("padded") == "  ", F.lit(0)).otherwise(_spaces(F.col("padded")) - 1)
    gate = F.lit(False)
    for word in GATE:
        gate = gate | F.contains("padded", F.lit(word))
    based = F.lit(False)
    for phrase, _ in BASE:
        based = based | F.contains("padded", F.lit(f" {phrase} "))
    none = F.array().cast(f"array<{SPAN}>")
    rows = rows.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.when(based, scan("padded", base_rules())).otherwise(none).alias("base"),
        F.when(gate, scan("padded", rules())).otherwise(none).alias("found"),
    )
    rows = rows.withColumn("detections", F.when(F.size("found") > 0, outermost("found")).otherwise(none)).drop("found")
    label = lambda array: F.transform(array, lambda s: s["label"])
    weight = F.array_max(F.transform(F.concat("base", "detections"), lambda s: s["weight"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(label("base"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(label("base"), label("detections")))), ",").alias("labels"),
        F.coalesce(weight, F.lit(0.0)).alias("score"),
        "base",
        "detections",
    )
