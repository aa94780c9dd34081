"""License scans by ordered signature rules, in DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.llm.common import keyed

# Words: runs of ASCII letters, digits and characters beyond ASCII. Case of A-Z is ignored by (?i), which in Java
# regards ASCII letters only.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# Phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licenses: label, SPDX identifiers, names, and the keyword without which no rule of theirs can match.
LICENSES = [
    ("mit", ["MIT", "X11"], ["MIT", "Expat", "X11"], None),
    ("apache", ["Apache-2.0", "Apache-1.1", "Apache-1.0"], ["Apache"], "apache"),
    ("gpl", ["GPL-2.0", "GPL-3.0", "GPL-1.0"], ["GNU General Public", "GNU GPL", "GPL"], None),
    ("lgpl", ["LGPL-2.0", "LGPL-2.1", "LGPL-3.0"],
     ["GNU Lesser General Public", "GNU Library General Public", "GNU LGPL", "LGPL"], None),
    ("agpl", ["AGPL-3.0", "AGPL-1.0"], ["GNU Affero General Public", "GNU AGPL", "AGPL"], None),
    ("fdl", ["GFDL-1.1", "GFDL-1.2", "GFDL-1.3"], ["GNU Free Documentation", "GFDL"], None),
    ("bsd", ["BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD"],
     ["BSD", "2-Clause BSD", "3-Clause BSD", "Simplified BSD", "Modified BSD", "New BSD"], "bsd"),
    ("mpl", ["MPL-1.0", "MPL-1.1", "MPL-2.0"], ["Mozilla Public", "MPL"], None),
    ("epl", ["EPL-1.0", "EPL-2.0"], ["Eclipse Public"], None),
    ("cddl", ["CDDL-1.0", "CDDL-1.1"], ["Common Development and Distribution", "CDDL"], None),
    ("cpl", ["CPL-1.0"], ["Common Public"], None),
    ("isc", ["ISC"], ["ISC"], None),
    ("zlib", ["Zlib"], ["zlib", "zlib/libpng"], "zlib"),
    ("boost", ["BSL-1.0"], ["Boost Software", "Boost"], None),
    ("artistic", ["Artistic-1.0", "Artistic-2.0"], ["Artistic"], "artistic"),
    ("unlicense", ["Unlicense"], ["Unlicense"], "unlicense"),
    ("wtfpl", ["WTFPL"], ["WTFPL"], "wtfpl"),
    ("eupl", ["EUPL-1.1", "EUPL-1.2"], ["European Union Public", "EUPL"], None),
    ("osl", ["OSL-3.0"], ["Open Software"], None),
    ("afl", ["AFL-3.0"], ["Academic Free"], None),
    ("python", ["PSF-2.0", "Python-2.0"], ["Python Software Foundation", "PSF"], None),
    ("php", ["PHP-3.0", "PHP-3.01"], ["PHP"], "php"),
    ("ruby", ["Ruby"], ["Ruby"], "ruby"),
    ("openssl", ["OpenSSL"], ["OpenSSL"], "openssl"),
    ("ofl", ["OFL-1.0", "OFL-1.1"], ["SIL Open Font", "Open Font"], None),
    ("odbl", ["ODbL-1.0"], ["Open Database", "ODbL"], None),
    ("odc-by", ["ODC-By-1.0"], ["Open Data Commons Attribution"], None),
    ("pddl", ["PDDL-1.0"], ["Public Domain Dedication and"], None),
    ("ncsa", ["NCSA"], ["University of Illinois/NCSA Open Source"], "ncsa"),
    ("ms-pl", ["MS-PL"], ["Microsoft Public"], None),
    ("ms-rl", ["MS-RL"], ["Microsoft Reciprocal"], None),
    ("cc-by", ["CC-BY-3.0", "CC-BY-4.0"], ["Creative Commons Attribution", "CC BY"], None),
    ("cc-by-sa", ["CC-BY-SA-3.0", "CC-BY-SA-4.0"], ["Creative Commons Attribution-ShareAlike", "CC BY-SA"], None),
    ("cc-by-nc", ["CC-BY-NC-3.0", "CC-BY-NC-4.0"], ["Creative Commons Attribution-NonCommercial", "CC BY-NC"], None),
    ("cc-by-nd", ["CC-BY-ND-3.0", "CC-BY-ND-4.0"], ["Creative Commons Attribution-NoDerivatives", "CC BY-ND"], None),
    ("cc-by-nc-sa", ["CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0"],
     ["Creative Commons Attribution-NonCommercial-ShareAlike", "CC BY-NC-SA"], None),
    ("cc-by-nc-nd", ["CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0"],
     ["Creative Commons Attribution-NonCommercial-NoDerivatives", "CC BY-NC-ND"], None),
    ("cc0", ["CC0-1.0"], ["CC0", "Creative Commons Zero"], None),
]
# How a name stands in a text: pattern around {name} or {id}, priority (higher decides), confidence.
NAME_FORMS = [
    (r"(?:licen[sc]ed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
     r"{name}(?:\s+licen[sc]e)?(?:,?\s+v(?:ersion)?\.?\s*\d+(?:\.\d+)*|\s+\d+(?:\.\d+)*)?", 2, 0.95),
    (r"{name}\s+licen[sc]e(?:,?\s+v(?:ersion)?\.?\s*\d+(?:\.\d+)*|\s+\d+(?:\.\d+)*)?", 1, 0.8),
    (r"licen[sc]e:\s*(?:the\s+)?{name}", 1, 0.75),
]
ID_FORMS = [
    (r"spdx-license-identifier:\s*\(?{id}(?:-only|-or-later|\+)?", 3, 1.0),
    (r"licen[sc]e[\"']?\s*[:=]\s*[\"']?{id}", 2, 0.9),
    (r"(?:opensource\.org/licenses|spdx\.org/licenses|creativecommons\.org/licenses)/{id}", 2, 0.9),
]
# Texts by which a license is known without its name: label, pattern, keyword (one word, as any white space may stand
# between words), priority, confidence.
TEXT_RULES = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", "granted", 3, 1.0),
    ("isc", r"permission to use, copy, modify, and(?:/or)? distribute this software", "permission", 3, 1.0),
    ("bsd", r"redistribution and use in source and binary forms", "redistribution", 3, 1.0),
    ("gpl", r"this program is free software[:;] you can redistribute it", "redistribute", 3, 0.95),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "as-is", 3, 0.9),
    ("unlicense", r"free and unencumbered software released into the public domain", "unencumbered", 3, 1.0),
    ("public-domain", r"(?:dedicated to|released into|placed in) the public domain", "domain", 2, 0.8),
    ("proprietary", r"all rights reserved", "reserved", 0, 0.4),
]
PRIORITIES = range(4)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, regular expression, keyword, priority, confidence) of every rule."""

    def words(text: str) -> str:
        return re.sub(r"(?:\\ |\\-| |-)+", r"[\\s-]+", re.escape(text))

    out = []
    for label, ids, names, keyword in LICENSES:
        for name in names:
            for form, priority, confidence in NAME_FORMS:
                key = keyword or re.split(r"[ -]", name.lower())[0]
                out.append((label, _bounded(form.replace("{name}", words(name))), key, priority, confidence))
        for spdx in ids:
            for form, priority, confidence in ID_FORMS:
                key = re.split(r"-\d", spdx.lower())[0]
                out.append((label, _bounded(form.replace("{id}", re.escape(spdx))), key, priority, confidence))
    out += [(label, _bounded(pattern.replace(" ", r"\s+")), key, p, c) for label, pattern, key, p, c in TEXT_RULES]
    return out


def _bounded(pattern: str) -> str:
    """Not within a longer word, nor followed by the rest of a longer identifier."""
    return rf"(?i)(?<!{WORD})(?:{pattern})(?!{WORD}|[-.]{WORD})"


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+"))


def _starts(tried: DataFrame, group: list[str]) -> DataFrame:
    """Where each hit begins in a text split at its hits: (the group's columns, first, length), from ``parts`` and ``hits``.

    Parts and hits become rows and meet in a running sum, so the work is linear in them.
    """
    at = tried.select(*group, F.posexplode(F.arrays_zip("parts", "hits")).alias("place", "at")).filter("at.hits is not null")
    sizes = at.select(*group, "place", F.length("at.parts").cast("long").alias("gap"), F.length("at.hits").cast("long").alias("length"))
    until = Window.partitionBy(*group).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sizes.select(*group, (F.sum(F.col("gap") + F.col("length")).over(until) - F.col("length")).alias("first"), "length")


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License mentions of whole texts: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    Base mentions are places where the words of a base phrase stand consecutively, whatever is between them.
    ``labels`` adds those of the signature rules (``detections``). ``score`` is the highest confidence: 1 with a base
    mention, else that of the surest detection, 0 without any. No labels: empty texts.

    A null or empty text has no words. Null ids and repeated rows are rows of their own. An empty table gives no rows.
    """
    source = keyed(docs, id=id_col, text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    phrases = "|".join(f"{GAP}+".join(p.split()) for p in BASE)
    phrase = F.lit(rf"(?i)(?<!{WORD})(?:{phrases})(?!{WORD})")
    has = F.contains(F.lower("text"), F.lit("license"))
    none = F.array().cast("array<string>")
    scanned = source.select("row", "id", "text", _words(F.col("text")).cast("long").alias("n_words"), has.alias("has"))
    scanned = scanned.withColumn("hits", F.when(F.col("has"), F.regexp_extract_all("text", phrase, F.lit(0))).otherwise(none))
    # No word is cut by a hit, so the words before the first and after the last one say where these begin.
    some = F.size("hits") > 0
    before = _words(F.element_at(F.split("text", phrase, 2), 1)).cast("long")
    rest = _words(F.element_at(F.split("text", phrase), -1)) + _words(F.element_at("hits", -1))
    scanned = scanned.withColumn("first_word", F.when(some, before)).withColumn("last_word", F.when(some, F.col("n_words") - rest))
    of = F.create_map(*[F.lit(v) for p, name in BASE.items() for v in (p.split()[0], name)])
    base = F.array_sort(F.array_distinct(F.transform("hits", lambda x: of[F.lower(F.regexp_extract(x, "^[A-Za-z]+", 0))])))
    found = (
        detections(docs, id_col=id_col, text_col=text_col)
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max("confidence").alias("sure"))
    )
    out = scanned.select("row", "id", "n_words", F.size("hits").cast("long").alias("n_base"), "first_word", "last_word", base.alias("base"))
    return out.join(found, "row", "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("sure", F.lit(0.0))).alias("score"),
    )


def detections(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Detections that stand: (row, doc_id, label, first, last, priority, confidence), characters from 0, end exclusive.

    A rule is tried only on texts that hold its keyword. Of overlapping detections, one is dropped if its interval lies
    within that of another of at least its priority (equal interval and priority: the first label in order stays).
    """
    source = keyed(docs, id=id_col, text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    every = rules()
    keywords = sorted({key for _, _, key, _, _ in every})
    low = F.lower("text")
    # one cheap pass that most texts do not get beyond; every rule's text holds one of these
    gate = F.col("text").rlike(r"(?i)licen[sc]|released|distributed|available|published|hereby|permission\s+to|redistribution|"
                               r"free\s+software|as-is|unencumbered|public\s+domain|all\s+rights\s+reserved")  # fmt: skip
    held = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("low"), k))
    table = source.sparkSession.createDataFrame(every, "label string, rule string, key string, priority int, confidence double")
    # The rules are a fixed table of this module: a few hundred rows.
    tried = (
        source.filter(gate)
        .withColumn("low", low)
        .withColumn("key", F.explode(held))
        .drop("low")
        .join(F.broadcast(table), "key")
        .withColumn("hits", F.regexp_extract_all("text", F.col("rule"), F.lit(0)))
        .filter(F.size("hits") > 0)
        .withColumn("parts", F.split("text", F.col("rule")))
    )
    spans = (
        _starts(tried, ["row", "id", "label", "priority", "confidence", "rule"])
        .withColumn("last", F.col("first") + F.col("length"))
        .groupBy("row", "id", "label", "priority", "first", "last")
        .agg(F.max("confidence").alias("confidence"))
    )
    # In order of (first, longest, priority, label), an earlier row that ends no sooner contains this one.
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), F.desc("priority"), "label")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.max(F.when(F.col("priority") >= p, F.col("last"))).over(earlier) for p in PRIORITIES]
    within = F.coalesce(*[F.when(F.col("priority") == p, F.coalesce(ends[i], F.lit(-1))) for i, p in enumerate(PRIORITIES)])
    return spans.withColumn("within", within).filter("within < last").select(
        "row", F.col("id").alias("doc_id"), "label", "first", "last", "priority", "confidence"
    )
