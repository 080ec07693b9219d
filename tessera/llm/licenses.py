"""Operator 3: licence scans by ordered signature rules, with DataFrame functions only.

A text becomes its lower-case words, one space apart. Each rule is a pattern over words that begins
with a keyword, and has a label and a priority (1 is the strongest). A document without any keyword
is not looked at further; in others, each keyword's place is tried against that keyword's rules
only, over a window of words as long as any rule reaches. Of the places found, one that lies within
another of the same or a stronger priority is suppressed. All of it happens within a row, so that
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases that are always counted, and their labels. Fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licences: label, and a pattern of the words by which it goes. Fixed values.
_LICENSES = [
    ("apache-1.1", "apache (?:software )?licen[cs]e (?:version |v)?1 1"),
    ("apache-2.0", "apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)?"),
    ("apache", "apache (?:software )?licen[cs]e"),
    ("mit", "(?:mit|expat|x11) licen[cs]e"),
    ("isc", "isc licen[cs]e"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|freebsd|2 clause bsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd(?: style)? licen[cs]e"),
    ("gpl-1.0", "(?:gnu )?(?:general public licen[cs]e|gpl) ?(?:version |v)?1(?: 0)?"),
    ("gpl-2.0", "(?:gnu )?(?:general public licen[cs]e|gpl) ?(?:version |v)?2(?: 0)?"),
    ("gpl-3.0", "(?:gnu )?(?:general public licen[cs]e|gpl) ?(?:version |v)?3(?: 0)?"),
    ("gpl", "(?:gnu )?(?:general public licen[cs]e|gpl)"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl) ?(?:version |v)?2 1"),
    ("lgpl-3.0", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl) ?(?:version |v)?3(?: 0)?"),
    ("lgpl", "(?:gnu )?(?:(?:lesser|library) general public licen[cs]e|lgpl)"),
    ("agpl-3.0", "(?:gnu )?(?:affero general public licen[cs]e|agpl) ?(?:version |v)?3(?: 0)?"),
    ("agpl", "(?:gnu )?(?:affero general public licen[cs]e|agpl)"),
    ("mpl-1.1", "(?:mozilla public licen[cs]e|mpl) ?(?:version |v)?1 1"),
    ("mpl-2.0", "(?:mozilla public licen[cs]e|mpl) ?(?:version |v)?2(?: 0)?"),
    ("mpl", "mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse public licen[cs]e ?(?:version |v)?1(?: 0)?"),
    ("epl-2.0", "eclipse public licen[cs]e ?(?:version |v)?2(?: 0)?"),
    ("cddl-1.0", "common development and distribution licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("artistic-2.0", "artistic licen[cs]e(?: (?:version |v)?2(?: 0)?)?"),
    ("zlib", "zlib(?: libpng)? licen[cs]e"),
    ("boost-1.0", "boost software licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl(?: licen[cs]e)?"),
    ("eupl-1.2", "european union public licen[cs]e(?: (?:version |v)?1 2)?"),
    ("ofl-1.1", "sil open font licen[cs]e(?: (?:version |v)?1 1)?"),
    ("odbl-1.0", "open database licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("cc0-1.0", "cc0(?: 1 0)?(?: universal)?"),
    *(
        (f"cc-{kind}{version and '-' + version}", f"(?:cc {short}|creative commons {long})(?: licen[cs]e)?{version and ' (?:version |v)?' + version.replace('.', ' ')}(?: international| unported)?")
        for kind, short, long in (
            ("by", "by", "attribution"), ("by-sa", "by sa", "attribution share ?alike"), ("by-nc", "by nc", "attribution non ?commercial"), ("by-nd", "by nd", "attribution no ?derivatives"),
            ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?derivatives"),
        )
        for version in ("4.0", "3.0", "2.0", "")
    ),
    ("public-domain", "public domain"),
    ("proprietary", "(?:proprietary|commercial) licen[cs]e"),
]

#: How a licence is named: keyword, pattern before the licence, priority.
_FRAMES = [
    ("licensed", "licensed under (?:the )?(?:terms of (?:the )?)?", 1),
    ("released", "released (?:under|into) (?:the )?(?:terms of (?:the )?)?", 1),
    ("distributed", "distributed under (?:the )?(?:terms of (?:the )?)?", 1),
    ("available", "available under (?:the )?(?:terms of (?:the )?)?", 1),
    ("published", "published under (?:the )?(?:terms of (?:the )?)?", 1),
    ("subject", "subject to (?:the )?(?:terms of (?:the )?)?", 2),
    ("spdx", "spdx licen[cs]e identifier (?:the )?", 1),
]
#: Words with which a licence's own pattern begins, each the keyword of a rule of priority 3.
_FIRST = (
    "apache mit expat x11 isc simplified bsd freebsd gnu general gpl lesser library lgpl affero agpl mozilla mpl eclipse "
    "artistic zlib boost unlicense wtfpl european sil cc0 cc creative public proprietary commercial "
    "common open new modified revised original bsd 2 3 4"
).split()
#: Common words among them: a text passes the gate only by what must follow.
_COMMON = {"common": "common development", "open": "open database", **{x: f"{x} bsd" for x in ("new", "modified", "revised", "original")}, **{x: f"{x} clause" for x in "234"}}
#: Short SPDX identifiers that no pattern above has, and whether they tell a licence without a frame.
_SHORT = [
    ("mit", "mit", False), ("isc", "isc", False), ("zlib", "zlib", False), ("apache-2.0", "apache 2 0", True), ("apache-1.1", "apache 1 1", True), ("epl-1.0", "epl 1 0", True),
    ("epl-2.0", "epl 2 0", True), ("ofl-1.1", "ofl 1 1", True), ("odbl-1.0", "odbl 1 0", True), ("cddl-1.0", "cddl 1 0", True), ("boost-1.0", "bsl 1 0", True),
    ("artistic-2.0", "artistic 2 0", True), ("eupl-1.2", "eupl 1 2", True),
]
#: Other signatures: keyword, pattern, label, priority. Fixed values.
_OTHERS = [
    ("rights", "rights reserved", "reserved", 3),
    ("clause", "clause bsd(?: licen[cs]e)?", "bsd", 3),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright", 4),
    ("permission", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 2),
    ("permission", "permission to use copy modify and or distribute this software for any purpose", "isc", 2),
    ("redistribution", "redistribution and use in source and binary forms with or without modification are permitted", "bsd", 2),
    ("required", "required by applicable law or agreed to in writing", "apache-2.0", 2),
    ("unencumbered", "unencumbered software released into the public domain", "unlicense", 2),
    ("option", "option any later version", "or-later", 2),
    ("implied", "implied warranty of merchantability", "gpl", 2),
    ("permission", "permission of the (?:author|copyright holder|owner)", "permission", 4),
    ("noncommercial", "noncommercial use only", "restricted", 4),
    ("confidential", "confidential and proprietary", "proprietary", 3),
]
#: How sure a finding of each priority is, from 1.
_SURE = (1.0, 0.9, 0.7, 0.5)


def rules() -> list[tuple[int, str, str, str, int]]:
    """Rules in order: number, keyword, pattern, label, priority. Each licence is tried in each frame, and by itself."""
    found = [(word, before + f"(?:{pattern})", label, priority) for word, before, priority in _FRAMES for label, pattern in _LICENSES]
    found += [(word, f"(?={word} |{word}$)(?:{pattern})", label, 3) for label, pattern in _LICENSES for word in _FIRST if _begins(pattern, word)]
    found += _OTHERS
    found += [(word, before + short, label, priority) for word, before, priority in _FRAMES for label, short, _ in _SHORT]
    found += [(short.split()[0], short, label, 3) for label, short, alone in _SHORT if alone]
    return [(i, *x) for i, x in enumerate(found)]


def _begins(pattern: str, word: str) -> bool:
    """Whether some text of the pattern can begin with the word."""
    import re

    heads = re.sub(r"\(\?:gnu \)\?", "", pattern)
    options = [heads] if heads == pattern else [heads, "gnu " + heads]
    for x in options:
        m = re.match(r"\(\?:(?:\(\?:)?([^()]*)", x)
        if any(y.split(" ")[0].split("(")[0] == word for y in (m[1].split("|") if m else [x])):
            return True
    return False


#: No rule reaches further than so many words.
REACH = 24


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def normal(text: Column) -> Column:
    """The words of a text, in lower case (A-Z only), one space apart."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _literal(rule: tuple[int, str, str, str, int]) -> str:
    i, _, pattern, label, priority = rule
    quoted = [x.replace("\\", "\\\\").replace("'", "\\'") for x in (f"^({pattern})( |$)", label)]
    return f"named_struct('rule', {i}, 'pattern', '{quoted[0]}', 'label', '{quoted[1]}', 'priority', {priority})"


def _found(words: Column, known: list[tuple[int, str, str, str, int]]) -> Column:
    """Every place of every rule: array of (start, less_end, priority, label, rule), sorted."""
    by_word: dict[str, list] = {}
    for x in known:
        by_word.setdefault(x[1], []).append(x)
    own = None
    for word, mine in by_word.items():
        table = F.expr(f"array({', '.join(map(_literal, mine))})")
        own = (lambda x, w=word, t=table: F.when(x == w, t)) if own is None else (lambda x, w=word, t=table, o=own: o(x).when(x == w, t))
    keywords = list(by_word)

    def windows(w: Column) -> Column:
        placed = F.transform(w, lambda x, i: F.when(x.isin(keywords), F.struct(i.alias("start"), x.alias("word"), F.concat_ws(" ", F.slice(w, i + 1, REACH)).alias("text"))))
        return F.filter(placed, lambda x: x.isNotNull())

    def matches(at: Column) -> Column:
        hits = F.transform(own(at["word"]), lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", at["text"], r["pattern"], F.lit(1)).alias("text")))
        return F.transform(
            F.filter(hits, lambda h: h["text"] != ""),
            lambda h: F.struct(at["start"].alias("start"), (-(at["start"] + _spaces(h["text"]))).alias("less_end"), h["r"]["priority"].alias("priority"), h["r"]["label"].alias("label"), h["r"]["rule"].alias("rule")),
        )

    return F.array_sort(F.flatten(F.transform(_let(words, windows), matches)))


_PLACE = "struct<start:int,less_end:int,priority:int,label:string,rule:int>"


def _kept(places: Column) -> Column:
    """Places that do not lie within one of the same or a stronger priority, in one pass over the sorted places.

    ``reach`` has, for each priority, the furthest end of places so far of that priority or a
    stronger one. Places are folded 64 at a time, as each step copies what it adds to.
    """

    def one(state: Column, x: Column) -> Column:
        free = F.element_at(state["reach"], x["priority"]) < -x["less_end"]
        reach = F.transform(state["reach"], lambda v, k: F.when(k + 1 >= x["priority"], F.greatest(v, -x["less_end"])).otherwise(v))
        return F.struct(reach.alias("reach"), F.when(free, F.concat(state["out"], F.array(x))).otherwise(state["out"]).alias("out"))

    def many(state: Column, chunk: Column) -> Column:
        begin = F.struct(state["reach"].alias("reach"), F.array().cast(f"array<{_PLACE}>").alias("out"))
        return _let(F.aggregate(chunk, begin, one), lambda s: F.struct(s["reach"].alias("reach"), F.concat(state["out"], F.array(s["out"])).alias("out")))

    begin = F.struct(F.array(*[F.lit(-1)] * len(_SURE)).alias("reach"), F.array().cast(f"array<array<{_PLACE}>>").alias("out"))
    chunks = _let(places, lambda p: F.transform(F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)), F.lit(64)), lambda i: F.slice(p, i, 64)))
    return F.flatten(F.aggregate(chunks, begin, many, lambda s: s["out"]))


def scan_licenses(docs: DataFrame, text_col: str = "text", known: list[tuple[int, str, str, str, int]] | None = None) -> DataFrame:
    """docs with license columns, in place of columns so named; all rows and other columns stay.

    n_words (long); n_base (long; places of BASE phrases), first_word and last_word (their smallest
    and largest start, from 0, else null), base_labels; places (array of start, end, priority,
    label, rule: what is left of the rules' findings); labels (of both, distinct, sorted,
    comma-joined); score (0 to 1; how sure the surest finding is). A null or empty text has no
    words and no labels. ``known`` replaces rules(), in the same form; a rule's pattern must begin
    with its keyword and reach at most REACH words.
    """
    passing = {x[1] for x in known} if known else {_COMMON.get(x[1], x[1]) for x in rules()}
    known = known or rules()
    ours = ["n_words", "n_base", "first_word", "last_word", "base_labels", "places", "labels", "score"]
    rest = docs.drop(*ours, "_s", "_p")
    text = rest.withColumn("_s", normal(F.coalesce(F.col(text_col), F.lit(""))))
    padded = F.concat(F.lit(" "), F.col("_s"), F.lit(" "))
    has = {label: F.contains(padded, F.lit(f" {phrase} ")) for phrase, label in BASE.items()}
    some = None
    for x in has.values():
        some = x if some is None else some | x
    cut = F.when(some, F.split(padded, f"(?<= )(?=(?:{'|'.join(BASE)}) )"))
    gate = F.col("_s").rlike(f"(?:^| )(?:{'|'.join(sorted(passing))})(?: |$)")
    none = F.array().cast(f"array<{_PLACE}>")
    first = text.select(
        "*",
        F.when(F.col("_s") == "", 0).otherwise(_spaces(F.col("_s")) + 1).cast("long").alias("n_words"),
        _let(cut, lambda c: F.struct(F.coalesce(F.size(c) - 1, F.lit(0)).alias("n"), (_spaces(c[0]) - 1).alias("first"), _spaces(F.element_at(c, -1)).alias("last"))).alias("_b"),
        F.array_compact(F.array(*(F.when(x, F.lit(label)) for label, x in sorted(has.items())))).alias("_l"),
        F.when(gate, _kept(_found(F.split("_s", " "), known))).otherwise(none).alias("_p"),
    )
    some = F.col("_b.n") > 0
    surest = F.array_min(F.transform("_p", lambda x: x["priority"]))
    sure = F.lit(0.0)
    for i, x in enumerate(_SURE, 1):
        sure = F.when(surest == i, x).otherwise(sure)
    return first.select(
        *(F.col(f"`{x}`") for x in rest.columns), "n_words",
        F.when(some, F.col("_b.n")).otherwise(0).cast("long").alias("n_base"),
        F.when(some, F.col("_b.first")).cast("long").alias("first_word"),
        F.when(some, F.col("n_words") - F.col("_b.last")).cast("long").alias("last_word"),
        F.array_join("_l", ",").alias("base_labels"),
        F.transform("_p", lambda x: F.struct(x["start"].alias("start"), (-x["less_end"]).alias("end"), x["priority"].alias("priority"), x["label"].alias("label"), x["rule"].alias("rule"))).alias("places"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_l", F.transform("_p", lambda x: x["label"])))), ",").alias("labels"),
        F.greatest(sure, F.when(some, F.lit(0.5)).otherwise(0.0)).alias("score"),
    )


def scan_sql() -> str:
    """DuckDB SQL for the scan of documents: by every place of every word, and every pair of findings."""
    rows = ",\n".join(f"({i}, '{word}', '^(' || '{pattern}' || ')( |$)', '{label}', {priority})" for i, word, pattern, label, priority in _plain())
    base = ", ".join(f"('{phrase}', {len(phrase.split())}, '{label}')" for phrase, label in BASE.items())
    return rf"""
WITH rules(rule, word, pattern, label, priority) AS (VALUES {rows}),
base(phrase, n, label) AS (VALUES {base}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
words AS (SELECT r, words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
starts AS (SELECT r, i - 1 AS i, label FROM words JOIN base ON word = split_part(phrase, ' ', 1) AND array_to_string(words[i : i + n - 1], ' ') = phrase),
bases AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS labels FROM starts GROUP BY r),
seen AS (SELECT r, i - 1 AS a, rules.*, regexp_extract(array_to_string(words[i : i + {REACH - 1}], ' '), pattern, 1) AS got FROM words JOIN rules USING (word)),
found AS (SELECT *, a + len(string_split(got, ' ')) - 1 AS b FROM seen WHERE got <> ''),
kept AS (SELECT * FROM found AS d WHERE NOT EXISTS (SELECT 1 FROM found AS e WHERE e.r = d.r AND e.a <= d.a AND e.b >= d.b AND e.priority <= d.priority
  AND (e.a < d.a OR e.b > d.b OR e.priority < d.priority OR e.label < d.label OR (e.label = d.label AND e.rule < d.rule)))),
best AS (SELECT r, list(DISTINCT label) AS labels, min(priority) AS p FROM kept GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, bases.a::BIGINT AS first_word, bases.b::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(bases.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bases.labels, []), coalesce(best.labels, [])))), ',') AS labels,
  greatest(coalesce([{', '.join(map(str, _SURE))}][p], 0.0), CASE WHEN n > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM docs LEFT JOIN bases USING (r) LEFT JOIN best USING (r)"""


def _plain() -> list[tuple[int, str, str, str, int]]:
    """rules() without look-ahead: SQL tries a rule only where its keyword stands."""
    return [(i, word, pattern.split("$)", 1)[1] if pattern.startswith("(?=") else pattern, label, priority) for i, word, pattern, label, priority in rules()]
