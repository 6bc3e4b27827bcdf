"""License scan: short phrases by consecutive words, license templates by an
exact set-similarity join (all DataFrame functions).

Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased.

*Base labels*: every place where a phrase's words stand consecutively.

*Template labels*: a template is the set of distinct words of a license
notice; a text block is ``SPAN`` consecutive words (twice the longest
template), one beginning every ``SPAN / 2`` words, so that any run of words as
long as a template lies whole inside a block.  A block meets a template T if
it holds ``need = ceil(PERCENT / 100 |T|)`` of its words.  The join is that of
prefix filtering:

1. One pass counts in how many documents each template word occurs.  Rarest
   first (ties by the word) is the global order; words are ranks in it.
2. A block that meets T holds one of T's first ``|T| - need + 1`` words, its
   prefix.  The prefixes are posted in an inverted list: word -> (template,
   place in the template).  Documents and blocks without any posted word are
   passed over.
3. Every other block becomes the sorted ranks of its template words and probes
   the list.  Length filter: it has at least ``need`` ranks.  Positional
   filter: with the shared word at place p of T and q of the block,
   ``1 + min(|T| - p - 1, |block| - q - 1) >= need``; the first shared word
   of a block that meets T passes both, so none is lost.
4. What passes is verified by the size of the intersection.

The templates are a short list, so their index is a constant in the plan and
each document is joined where it is read: no shuffle, no state between rows,
nothing to lose with an executor but a task.  What reaches the driver is one
count per template word.

``score`` is 1 for documents with a base label, otherwise the largest share of
a template's words found in a block that meets it, 0 if there is none.

Null, empty or wordless texts have no labels, no places and score 0.  Texts
of any length are scanned whole.  Repeated rows and ids are scanned each for
itself.  Equal frequencies are ordered by the word.  Other columns, of
whatever name, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PERCENT = 80

# The phrases of the base labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Sentences of license notices, as published, and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "creative-commons"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved no part of this publication may be reproduced without prior written permission",
     "all-rights-reserved"),
)


def words_of(col: Column) -> Column:
    """The words of a text.  U+212A is the one other letter whose lower case is
    an ASCII word by itself; it must not become k."""
    kept = F.replace(F.coalesce(col, F.lit("")), F.lit("\u212A"), F.lit("\uE000"))
    return F.array_remove(F.split(F.lower(kept), SEPARATORS), "")


def places(words: str, phrase: str) -> Column:
    """Starts (from 0) of all places where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    room = F.size(words) - len(parts)
    all_there = reduce(and_, [F.array_contains(words, p) for p in dict.fromkeys(parts)], room >= 0)
    return (F.when(all_there, F.filter(F.sequence(F.lit(0), room), lambda i: reduce(
        and_, [F.get(words, i + j) == p for j, p in enumerate(parts)])))
        .otherwise(F.array().cast("array<int>")))


@dataclass(frozen=True)
class Template:
    label: str
    ranks: tuple[int, ...]  # its words in the global order
    need: int  # words that a block must hold

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.ranks[:len(self.ranks) - self.need + 1]


def _span(templates) -> int:
    return 2 * max((len(t.split(" ")) for t, _ in templates), default=1)


def vocabulary(templates) -> list[str]:
    return sorted({w for t, _ in templates for w in t.split(" ")})


def global_order(words: DataFrame, templates) -> list[str]:
    """The template words, those in the fewest documents first (one count each)."""
    vocab = vocabulary(templates)
    found = words.select(F.explode(F.array_intersect("words", F.lit(vocab))).alias("w")).groupBy("w").count()
    count = {r["w"]: r["count"] for r in found.collect()}
    return sorted(vocab, key=lambda w: (count.get(w, 0), w))


def ranked(templates, order: list[str], percent: int = PERCENT) -> list[Template]:
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for text, label in templates:
        ranks = tuple(sorted({rank[w] for w in text.split(" ")}))
        out.append(Template(label, ranks, -(-percent * len(ranks) // 100)))
    return out


def matches(words: str, templates: list[Template], order: list[str], span: int) -> Column:
    """``array<struct<t int, common int>>``: the blocks that meet a template, by
    template number and shared words.  ``words`` names an array column."""
    postings: dict[int, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        for p, r in enumerate(template.prefix):
            postings.setdefault(r, []).append((t, p))
    posted = F.lit([order[r] for r in sorted(postings)])
    lists = F.create_map(*[x for r, at in sorted(postings.items()) for x in (F.lit(r), F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in at]))])
    sizes, needs = F.lit([len(t.ranks) for t in templates]), F.lit([t.need for t in templates])
    sets = F.array(*[F.lit(list(t.ranks)) for t in templates])
    ranks = F.create_map(*[x for i, w in enumerate(order) for x in (F.lit(w), F.lit(i))])
    vocab = F.lit(order)

    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(span // 2))
    blocks = F.filter(F.transform(starts, lambda s: F.slice(words, s, span)), lambda b: F.arrays_overlap(b, posted))
    blocks = F.transform(blocks, lambda b: F.array_sort(F.transform(F.array_intersect(b, vocab), lambda w: F.element_at(ranks, w))))

    def probed(block: Column) -> Column:
        hits = F.flatten(F.transform(block, lambda r, q: F.transform(
            F.coalesce(F.try_element_at(lists, r), F.array().cast("array<struct<t:int,p:int>>")),
            lambda at: F.struct(at["t"].alias("t"), at["p"].alias("p"), q.alias("q")))))
        n = F.size(block)
        passed = F.filter(hits, lambda h: (n >= F.get(needs, h["t"])) & (
            1 + F.least(F.get(sizes, h["t"]) - h["p"], n - h["q"]) - 1 >= F.get(needs, h["t"])))
        candidates = F.array_distinct(F.transform(passed, lambda h: h["t"]))
        return F.transform(candidates, lambda t: F.struct(
            t.alias("t"), F.size(F.array_intersect(block, F.get(sets, t))).alias("common")))

    found = F.filter(F.flatten(F.transform(blocks, probed)), lambda m: m["common"] >= F.get(needs, m["t"]))
    return F.when(F.arrays_overlap(words, posted), found).otherwise(F.array().cast("array<struct<t:int,common:int>>"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """The contract of op12: one row per document, labels joined by commas."""
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    order = global_order(words, templates)
    sets = ranked(templates, order, percent)
    names, sizes = F.lit([t.label for t in sets]), F.lit([len(t.ranks) for t in sets])
    at = [f"at{i}" for i in range(len(phrases))]
    rows = words.select("doc_id", F.size("words").cast("long").alias("n_words"),
                        *[places("words", p).alias(a) for a, (p, _) in zip(at, phrases)],
                        matches("words", sets, order, _span(templates)).alias("met"))
    every = F.concat(*at)
    base = F.flatten(F.array(*[F.when(F.size(a) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
                               for a, (_, label) in zip(at, phrases)]))
    share = F.array_max(F.transform("met", lambda m: m["common"].cast("double") / F.get(sizes, m["t"])))
    return rows.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, F.transform("met", lambda m: F.get(names, m["t"])))).alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"))


def _oracle(phrases=PHRASES, templates=TEMPLATES, percent: int = PERCENT) -> str:
    span = _span(templates)
    def values(rows, cols):
        return f"(VALUES {', '.join(str((a.split(' '), b)) for a, b in rows)}) AS x({cols})"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, list_filter(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT * FROM {values(phrases, "phrase, label")}),
t AS (SELECT list_distinct(notice) AS notice, label FROM {values(templates, "notice, label")}),
b AS (SELECT id, label, i FROM d, p, range(len(words)::BIGINT) AS r(i) WHERE words[i + 1:i + len(phrase)] = phrase),
k AS (SELECT id, words[i:i + {span - 1}] AS block FROM d, range(1, len(words)::BIGINT + 1, {span // 2}) AS r(i)),
m AS (SELECT id, label, len(list_intersect(block, notice)) AS common, len(notice) AS size FROM k, t
      WHERE 100 * len(list_intersect(block, notice)) >= {percent} * len(notice)),
x AS (SELECT id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY id),
y AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT id, label FROM b UNION ALL SELECT id, label FROM m) GROUP BY id),
z AS (SELECT id, max(common / size) AS share FROM m GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       (CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END)::DOUBLE AS score
FROM d LEFT JOIN x USING (id) LEFT JOIN y USING (id) LEFT JOIN z USING (id)
"""


ORACLE = _oracle()
