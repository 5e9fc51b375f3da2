"""License detection by ordered signature rules.

A text is reduced to its words. Words that occur in some rule's keyword open that rule; an opened rule is a
regular expression over the words. Where detections overlap, one that lies inside another of the same or a
better priority is suppressed. Everything happens inside the row with column functions.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are scanned each
by themselves; extra columns pass through and give way to result columns of the same name.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import scan, spans_of, whole
from millrace.operators.once import with_once

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases every scan must place, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.5


@dataclass(frozen=True)
class Family:
    """A license with its names in words, its short forms and its versions.

    Every name holds the keyword, or one of the keywords parted by ``|``, as a word of its own.
    """

    label: str
    keyword: str
    name: str
    short: str = ""
    versions: tuple[str, ...] = ()


FAMILIES = (
    Family("apache", "apache", "apache(?: software)?(?: foundation)?", "apache|asl", ("1.0", "1.1", "2.0")),
    Family("mit", "mit", "mit(?: x11)?", "expat|mit"),
    Family("isc", "isc", "isc", "isc"),
    Family("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    Family("boost", "boost", "boost software", "bsl", ("1.0",)),
    Family("gpl", "gnu", "gnu general public|gnu gpl", "gnu gpl", ("1.0", "2.0", "3.0")),
    Family("gpl", "gpl", "gpl", "gpl", ("1.0", "2.0", "3.0")),
    Family("lgpl", "gnu", "gnu lesser general public|gnu library general public|gnu lgpl", "gnu lgpl", ("2.0", "2.1", "3.0")),
    Family("lgpl", "lgpl", "lgpl", "lgpl", ("2.0", "2.1", "3.0")),
    Family("agpl", "affero", "(?:gnu )?affero general public", "affero gpl", ("1.0", "3.0")),
    Family("agpl", "agpl", "agpl", "agpl", ("1.0", "3.0")),
    Family("gfdl", "gnu", "gnu free documentation", "gnu fdl", ("1.1", "1.2", "1.3")),
    Family("mpl", "mozilla", "mozilla public", "mozilla pl", ("1.0", "1.1", "2.0")),
    Family("mpl", "mpl", "mpl", "mpl", ("1.0", "1.1", "2.0")),
    Family("epl", "eclipse", "eclipse public", "eclipse pl", ("1.0", "2.0")),
    Family("epl", "epl", "epl", "epl", ("1.0", "2.0")),
    Family("cddl", "distribution", "common development and distribution", "", ("1.0", "1.1")),
    Family("cddl", "cddl", "cddl", "cddl", ("1.0", "1.1")),
    Family("cpl", "common", "common public", "", ("1.0",)),
    Family("eupl", "eupl", "eupl", "eupl", ("1.0", "1.1", "1.2")),
    Family("eupl", "european", "european union public", "", ("1.0", "1.1", "1.2")),
    Family("artistic", "artistic", "artistic", "artistic", ("1.0", "2.0")),
    Family("ofl", "font", "sil open font|open font", "", ("1.0", "1.1")),
    Family("ofl", "ofl", "ofl", "sil ofl|ofl", ("1.0", "1.1")),
    Family("psf", "python|psf", "python software foundation|psf", "", ("2.0",)),
    Family("ms-pl", "microsoft", "microsoft public", "ms pl"),
    Family("ms-rl", "microsoft", "microsoft reciprocal", "ms rl"),
    Family("unlicense", "unlicense", "unlicense", "unlicense"),
    Family("wtfpl", "wtfpl", "wtfpl", "wtfpl", ("1.0", "2.0")),
    Family("odbl", "database", "open database", "", ("1.0",)),
    Family("odc-by", "data", "open data commons attribution", "", ("1.0",)),
    Family("cecill", "cecill", "cecill(?: b| c)?", "cecill", ("1.0", "2.0", "2.1")),
    Family("mulan", "mulan", "mulan (?:permissive software|psl)", "mulan psl", ("1.0", "2.0")),
    Family("upl", "upl|universal", "upl|universal permissive", "upl", ("1.0",)),
    Family("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", "bsd 2"),
    Family("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", "bsd 3"),
    Family("bsd-4-clause", "bsd", "(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause", "bsd 4"),
    Family("bsd", "bsd", "bsd(?: style)?", "bsd"),
)

# Short forms that also mean other things (a parser, a protocol, a release): they only count as names of a license.
MANY_MEANINGS = {"expat", "mit", "isc", "zlib", "bsd", "bsd 4"}

# Creative Commons: short elements, their names, versions.
COMMONS = {
    "by": "attribution", "by sa": "attribution share ?alike", "by nc": "attribution non ?commercial",
    "by nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Sentences of whole license texts and notices: label, keywords, pattern.
SENTENCES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "domain", "(?:this work|it|work) is (?:in|within) the public domain"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "creative", "creative commons zero(?: v?1 0)?(?: universal)?"),
    ("wtfpl", "want", "do what the fuck you want to public license"),
    ("beerware", "beerware", "beerware(?: license)?"),
    ("reserved", "rights", "all rights reserved"),
    ("no-warranty", "warranty", "(?:as is|is provided as is) without warranty of any kind"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|distribution|reproduction) (?:of [^ ]+ [^ ]+ )?(?:via any medium )?is (?:strictly )?prohibited"),
    ("non-commercial", "commercial|noncommercial", "for non ?commercial (?:use|purposes) only"),
    ("no-derivatives", "derivative", "no derivative works (?:are )?(?:allowed|permitted)"),
    ("patent-grant", "patent", "grants? (?:to )?you a (?:perpetual|worldwide)(?: [^ ]+){0,8} patent license"),
)

GRANT = "(?:licensed|released|distributed|available|provided|published|shared) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
LICENSE = "(?: public)?(?: licen[sc]e)?"


def version_words(version: str) -> str:
    major, minor = version.split(".")
    return f"{major}(?: 0)?" if minor == "0" else f"{major} {minor}"


def build_rules() -> list[dict]:
    """All signature rules, best priority first; a number is a rule's place in the order."""
    rules = []

    def add(priority: int, label: str, keywords: str, pattern: str, weight: float, partners: tuple[str, ...] = ()) -> None:
        # One rule for each keyword. If several open, they find the same places, and only the first is not suppressed.
        for keyword in keywords.split("|"):
            rules.append({"priority": priority, "label": label, "keyword": keyword, "partners": partners, "pattern": pattern, "weight": weight})

    for family in FAMILIES:
        name = f"(?:{family.name})"
        for version in family.versions:
            label, v = f"{family.label}-{version}", version_words(version)
            for suffix, later in (("-or-later", " (?:or(?: at your option)? (?:any )?later(?: version)?|only or later)"), ("", "")):
                if suffix and not family.label.endswith("gpl"):
                    continue
                add(2, label + suffix, family.keyword, f"{GRANT}{name}{LICENSE}(?: version| v)? v?{v}{later}", 1.0)
                add(3, label + suffix, family.keyword, f"{name}{LICENSE}(?: version| v)? v?{v}{later}", 0.9)
            add(1, label, "spdx", f"spdx license identifier {family.label.replace('-', ' ')} {v}", 1.0)
            for short in filter(None, family.short.split("|")):
                # A version may be written onto the last word.
                first, *more = short.split()
                keys = first if more else f"{first}|{first}{version[0]}|{first}v{version[0]}"
                add(4, label, keys, f"{short} ?v?{v}", 0.8)
        if not family.versions:
            for short in filter(None, family.short.split("|")):
                if short not in MANY_MEANINGS:
                    add(6, family.label, short.split()[0], short, 0.6)
                elif short != family.name.split("(")[0]:
                    add(5, family.label, short.split()[0], f"{GRANT}{short}(?: licen[sc]e)?", 0.8, ("under",))
                    add(6, family.label, short.split()[0], f"{short} licen[sc]e", 0.6, ("license", "licence"))
            add(1, family.label, "spdx", f"spdx license identifier {family.label.replace('-', ' ')}", 1.0)
        add(5, family.label, family.keyword, f"{GRANT}{name}(?: public)?(?: licen[sc]e)?", 0.8, ("under",))
        add(6, family.label, family.keyword, f"{name}(?: public)? licen[sc]e", 0.6, ("license", "licence"))
    for elements, name in COMMONS.items():
        short = f"cc-{elements.replace(' ', '-')}"
        for version in COMMONS_VERSIONS:
            label, v = f"{short}-{version}", version_words(version)
            add(1, label, "spdx", f"spdx license identifier cc {elements} {v}", 1.0)
            add(2, label, "cc", f"{GRANT}(?:a )?cc {elements} {v}", 1.0)
            add(3, label, "cc", f"cc {elements} {v}", 0.9)
            add(3, label, "creative", f"creative commons {name}(?: licen[sc]e)?(?: version)? {v}", 0.9)
            add(4, label, "creativecommons", f"creativecommons org licenses {elements} {v}", 0.9)
        add(5, short, "cc", f"cc {elements}", 0.7)
        add(5, short, "creative", f"creative commons {name}(?: licen[sc]e)?", 0.7)
    for label, keyword, pattern in SENTENCES:
        add(2, label, keyword, pattern, 0.95)
    return [rule | {"number": n} for n, rule in enumerate(sorted(rules, key=lambda r: r["priority"]))]


def spaced(pattern: str) -> str:
    """The pattern over words that stand between two blanks each, so that neighbours share none."""
    return " " + pattern.replace(" ", "  ").replace("  ?", "(?:  )?") + " "


RULE_SCHEMA = "array<struct<number:int,priority:int,label:string,keyword:string,partners:array<string>,pattern:string,weight:double>>"
FOUND = "array<struct<start:int,minus_end:int,priority:int,number:int,label:string,weight:double>>"


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_before(piece: Column) -> Column:
    return ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("int")


def rule_table(rules: list[dict]) -> Column:
    return F.from_json(F.lit(json.dumps([r | {"pattern": spaced(r["pattern"])} for r in rules])), RULE_SCHEMA)


def gate_words(rules: list[dict]) -> Column:
    """Words that can open a rule or a base phrase."""
    words = {w for r in rules for w in (r["keyword"], *r["partners"])} | {p.split()[0] for p in BASE_PHRASES}
    return F.array(*[F.lit(w) for w in sorted(words)])


def open_rules(present: Column, rules: list[dict]) -> Column:
    """Rules whose keyword, and one of whose partner words if it has any, the text holds."""
    return F.when(F.size(present) > 0, F.filter(rule_table(rules), lambda r: F.array_contains(present, r["keyword"]) & (
        (F.size(r["partners"]) == 0) | F.arrays_overlap(present, r["partners"])))).otherwise(F.array().cast(RULE_SCHEMA))


def detections(line: Column, opened: Column, rules: list[dict]) -> Column:
    """Surviving detections of one text, by start: array of (start, minus_end, priority, number, label, weight)."""
    fitting = F.filter(opened, lambda r: F.rlike(line, r["pattern"]))
    raw = F.flatten(F.transform(fitting, lambda r: F.transform(spans_of(line, r["pattern"], size=words_before), lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("minus_end"), r["priority"].alias("priority"),
        r["number"].alias("number"), r["label"].alias("label"), r["weight"].alias("weight")))))
    # In this order nothing later can contain what came before; reach[p] is the furthest end at priority p.
    levels = max(r["priority"] for r in rules)
    def step(acc: Column, x: Column) -> tuple[list[Column], Column]:
        end = -x["minus_end"]
        inside = F.array_max(F.slice(acc["reach"], F.lit(1), x["priority"] + 1)) >= end
        reach = F.transform(acc["reach"], lambda r, i: F.when(i == x["priority"], F.greatest(r, end)).otherwise(r))
        return [reach.alias("reach")], F.when(~inside, x)

    return F.when(F.size(opened) > 0, scan(
        F.sort_array(raw), {"reach": F.array_repeat(F.lit(0), levels + 1)}, step, FOUND.removeprefix("array<").removesuffix(">"))).otherwise(
        F.array().cast(FOUND))


def phrase_places(line: Column, phrase: str, label: str) -> Column:
    pattern = F.lit(spaced(phrase))
    return F.when(F.contains(line, pattern), F.transform(
        spans_of(line, pattern, size=words_before), lambda x: F.struct(x["start"].alias("start"), F.lit(label).alias("label")))).otherwise(
        F.array().cast("array<struct<start:int,label:string>>"))


def scan_licenses(df: DataFrame, text: str = "text", rules: list[dict] | None = None) -> DataFrame:
    """Add what the rules find in every whole text.

    New columns: ``n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``licenses``, an
    array of (first, end, label, weight) in words.
    """
    rules = rules if rules is not None else build_rules()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "licenses"]
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    body = whole(F.col(f"`{text}`"))
    # Full lower-casing is fast and makes the same words, but may turn a foreign letter into an ASCII one: good
    # enough to open rules. The exact line is only made for texts that open one.
    read = df.select(*rest, body.alias("_l_text"), F.array_remove(F.split(F.lower(body), NOT_WORD), "").alias("_l_words"))
    gated = read.select(
        *rest, "_l_text", F.size("_l_words").cast("long").alias("n_words"),
        F.array_intersect("_l_words", gate_words(rules)).alias("_l_present"))
    opened = gated.select(*rest, "_l_text", "n_words", "_l_present", open_rules(F.col("_l_present"), rules).alias("_l_open"))
    wanted = (F.size("_l_open") > 0) | F.arrays_overlap("_l_present", F.array(*[F.lit(p.split()[0]) for p in BASE_PHRASES]))
    words = F.array_remove(F.split(lower_ascii(F.col("_l_text")), NOT_WORD), "")
    lined = opened.select(*rest, "n_words", "_l_open", F.when(
        wanted, F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))).otherwise("").alias("_l_line"))
    base = F.flatten(F.array(*[
        phrase_places(F.col("_l_line"), phrase, label) for phrase, label in BASE_PHRASES.items()]))
    # Held once, so that a filter on a result does not repeat all of this below itself.
    found = with_once(lined, "_l_held", F.struct(
        base.alias("_l_base"), detections(F.col("_l_line"), F.col("_l_open"), rules).alias("_l_found"))).select(
        *rest, "n_words", "_l_held.*")
    base_labels = F.array_sort(F.array_distinct(F.transform("_l_base", lambda x: x["label"])))
    named = F.array_union(F.transform("_l_found", lambda x: x["label"]), F.transform("_l_base", lambda x: x["label"]))
    best = F.array_max(F.transform("_l_found", lambda x: x["weight"]))
    return found.select(
        *rest, "n_words", F.size("_l_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_l_base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_l_base", lambda x: x["start"])).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("_l_base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
        F.transform("_l_found", lambda x: F.struct(
            x["start"].alias("first"), (-x["minus_end"]).alias("end"), x["label"].alias("label"),
            x["weight"].alias("weight"))).alias("licenses"))
