"""Licence recognition by sentence rules, in DataFrame functions only.

A text is cut into sentences, whose lines may be wrapped anywhere, each is normalised
to lower-case words, and every sentence that holds known licence phrases is replaced
by their identifiers in order, everything else by a break. The identifier sequence is
then matched against rules, which are sequences of identifiers in order; neighbours in
a rule must be neighbours in the text, but for blank sentences and list numbers. Rules are tried from the longest to the shortest, and what a
longer rule has covered is not matched again by a shorter one.

Null and empty texts, and texts without a known sentence, give an empty list.
Repeated sentences give their licence once. Rows may repeat and each is answered.
An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-ref",
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under cc by nc 4 0": "ccbync-ref",
    "licensed under cc by 4 0": "ccby-ref",
    "licensed under the apache license version 2 0 the license": "apache-head",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "mit-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "this software is provided by the copyright holders and contributors as is": "bsd-warranty",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-free",
    "this program is distributed in the hope that it will be useful": "gpl-hope",
    "all rights reserved": "reserved",
}
# Identifier sequences and the licence each one means, longest first.
RULES = [
    (("apache-head", "apache-use", "apache-copy"), "Apache-2.0"),
    (("mit-grant", "mit-notice", "mit-warranty"), "MIT"),
    (("apache-head", "apache-use"), "Apache-2.0"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("bsd-grant", "bsd-warranty"), "BSD"),
    (("gpl-free", "gpl-hope"), "GPL"),
    (("apache-ref",), "Apache-2.0"),
    (("mit-ref",), "MIT"),
    (("gpl3-ref",), "GPL-3.0"),
    (("ccbync-ref",), "CC-BY-NC-4.0"),
    (("ccby-ref",), "CC-BY-4.0"),
    (("mit-grant",), "MIT"),
    (("bsd-grant",), "BSD"),
    (("gpl-free",), "GPL"),
    (("reserved",), "proprietary"),
]
#: Every known sentence holds one of these, so texts without any need no further look.
ANCHORS = "(?i)licen[sc]e|permission|copyright|redistribut|warrant|program is distributed|rights reserved"
END = r"([.!?])[\x20\x09-\x0D]+"
#: Longer sentences than any known one are not worth normalising where they must be known as a whole.
LONGEST = 4 * max(map(len, SENTENCES))

# The constants above also state the SQL, which knows notices of one line each. The scan knows
# their phrases inside sentences, and those of the full notices.
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
_PUBLISHED = f"{_GPL} as published by the free software foundation either version"
# Normalised phrases and their identifiers.
PHRASES = {
    **SENTENCES,
    "in no event shall the authors or copyright holders be liable": "mit-liability",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "this software is provided by the copyright holder and contributors as is": "bsd-warranty",
    "this software is provided by the regents and contributors as is": "bsd-warranty",
    "this software is provided by the author as is": "bsd-warranty",
    "this software is provided by the author and contributors as is": "bsd-warranty",
    "in no event shall the copyright holder or contributors be liable": "bsd-liability",
    "in no event shall the copyright owner or contributors be liable": "bsd-liability",
    "in no event shall the copyright holders or contributors be liable": "bsd-liability",
    f"{_PUBLISHED} 3 of the license": "gpl3-free",
    f"{_PUBLISHED} 2 of the license": "gpl2-free",
}
_BSD = [
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-warranty", "bsd-liability"),
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability"),
    ("bsd-grant", "bsd-source", "bsd-binary"),
]
_NOTICES = [
    *RULES, *[(ids, "BSD") for ids in _BSD], (("mit-grant", "mit-notice", "mit-warranty", "mit-liability"), "MIT"),
    (("gpl3-free", "gpl-hope"), "GPL-3.0"), (("gpl3-free",), "GPL-3.0"), (("gpl2-free", "gpl-hope"), "GPL-2.0"), (("gpl2-free",), "GPL-2.0"),
]
# "All rights reserved" right before a grant is a part of that notice.
_GRANTS = ("mit-grant", "bsd-grant", "apache-head", "gpl-free", "gpl2-free", "gpl3-free")
#: Identifier sequences and the licence each one means, longest first.
SEQUENCES = sorted(
    [*_NOTICES, *[(("reserved", *ids), name) for ids, name in _NOTICES if ids[0] in _GRANTS]], key=lambda r: -len(r[0]))
#: As ANCHORS, wherever lines are wrapped.
NEAR = f"{ANCHORS}|software is provided".replace(" ", "[^a-z0-9]+")
#: Line ends with nothing between them.
BLANK = r"(?>\r\n|\n|\r)[\x20\x09\x0B\x0C]*(?>\r\n|\n|\r)"
#: What numbers an entry of a list is no sentence.
NUMBERING = r"(?i)^[^a-z0-9]*(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})?[^a-z0-9]*$"
# The longest phrase first, so that it wins where several start.
KNOWN = r"\b(?:" + "|".join(sorted(PHRASES, key=lambda p: (-len(p), p))) + r")\b"


def sentences(text: Column) -> Column:
    """Sentences end at a full stop, question or exclamation mark before white space, or at a blank line."""
    ended = F.regexp_replace(F.regexp_replace(text, BLANK, "\u0000"), END, "$1\u0000")
    return F.split(ended, "\u0000+")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the phrases in order, "-" for sentences without any, as one string: "|a|-|b|"."""
    known = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])

    def identify(s: Column) -> Column:
        # Cheap test first: only sentences that hold an anchor are normalised.
        found = F.transform(F.regexp_extract_all(normalised(s), F.lit(KNOWN), F.lit(0)), lambda p: F.try_element_at(known, p))
        return F.when(s.rlike(NEAR), F.coalesce(F.nullif(F.array_join(found, "|"), F.lit("")), F.lit("-"))).otherwise(F.lit("-"))

    filled = F.filter(sentences(text), lambda s: ~s.rlike(NUMBERING))
    ids = F.concat(F.lit("|"), F.array_join(F.transform(filled, identify), "|"), F.lit("|"))
    return F.when(text.rlike(NEAR), F.regexp_replace(ids, r"(\|-)+\|", "|-|")).otherwise(F.lit("|"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licenses (distinct, in the order of the rules) for every row."""
    out = docs.select("doc_id", F.coalesce(sentence_ids(F.col("text")), F.lit("|")).alias("sentence_ids"))
    # Each rule takes its sequence out of what longer ones left.
    left, found = F.col("sentence_ids"), []
    steps = out.withColumn("_left", left).withColumn("_found", F.lit(""))
    for ids, name in SEQUENCES:
        sequence = "|" + "|".join(ids) + "|"
        hit = F.contains("_left", F.lit(sequence))
        steps = steps.withColumns({
            "_found": F.when(hit & ~F.contains("_found", F.lit(f"{name},")), F.concat("_found", F.lit(f"{name},"))).otherwise(F.col("_found")),
            "_left": F.replace("_left", F.lit(sequence), F.lit("|-|")),
        })
    licences = F.filter(F.split("_found", ","), lambda x: x != "")
    return steps.select("doc_id", F.regexp_replace(F.regexp_replace("sentence_ids", r"(\|-)+\|", "|"), r"^\||\|$", "").alias("sentence_ids"), F.array_join(licences, ",").alias("licenses"))
