"""License scans: an exact set-similarity join of word windows with license templates.

A template is a list of words with a containment threshold; the blocks of a text are all its windows of as many words
(at the end of a text, fewer).  A block meets the template if it holds at least that share of the template's distinct
tokens.  Tokens are ordered by their frequency in the whole corpus, rarest first.  A block that meets the threshold
must hold one of the first ``s - need + 1`` tokens in this order (prefix filter), be at least ``need`` words long
(length filter), and still be able to reach ``need`` given the rank of the rarest token found (positional filter).
So only the windows around a rare token are built and verified; texts are scanned, never shuffled.

Templates of threshold 1 that are marked as phrases are checked once more for their exact word order.

Defined results: null and empty texts have no words and no places; rows repeating id and text give one row each; rows
sharing an id are judged apart; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import ascii_lower, whole, word_list


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.text.split()))

    @property
    def need(self) -> int:
        return math.ceil(self.threshold * len(self.tokens) - 1e-9)


# The phrases looked for, and the operative sentences of public licenses, as lower-case words.
PHRASES = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
)
NOTICES = (
    Template("apache-notice", "licensed under the apache license version 2 0"),
    Template("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by", "licensed under cc by 4 0", 1.0),
    Template("cc-by-nc", "licensed under cc by nc 4 0", 1.0),
    Template("cc-by-sa", "licensed under cc by sa 4 0", 1.0),
    Template("gpl-notice", "licensed under the gnu general public license version"),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-notice", "subject to the terms of the mozilla public license"),
)
TEMPLATES = PHRASES + NOTICES


def token_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """How often each template token stands in the corpus; as many numbers as the templates have tokens."""
    vocabulary = sorted({t for template in templates for t in template.tokens})
    token = docs.select(F.explode_outer(word_list(ascii_lower(whole("text")))).alias("token"))
    counted = token.where(F.col("token").isin(vocabulary)).groupBy("token").count().collect()
    return {t: 0 for t in vocabulary} | {row["token"]: row["count"] for row in counted}


def prefix_table(spark: SparkSession, frequencies: dict[str, int], templates: tuple[Template, ...]) -> DataFrame:
    """(token, template, rank): the prefix tokens of every template in global order, rarest first."""
    rows = []
    for number, template in enumerate(templates):
        ordered = sorted(template.tokens, key=lambda t: (frequencies[t], t))
        for rank, token in enumerate(ordered[: len(ordered) - template.need + 1]):
            rows.append(
                (token, number, rank, template.tokens, template.need, len(template.text.split()),
                 template.text if template.phrase else None)
            )
    return spark.createDataFrame(
        rows, "prefix string, template int, rank int, tokens array<string>, need int, length int, phrase string"
    )


def license_blocks(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row: n_words and the blocks met (template, start, containment), sorted; spelled phrases only in order."""
    # The table has a row per prefix token of the templates given: a few dozen.
    table = F.broadcast(prefix_table(docs.sparkSession, token_frequencies(docs, templates), templates))
    words = docs.select(
        "doc_id", F.xxhash64("text").alias("version"), word_list(ascii_lower(whole("text"))).alias("words")
    )
    tokens = words.select(
        "doc_id", "version", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "token")
    )
    probed = tokens.join(table, F.col("token") == F.col("prefix"), "left").where(
        F.col("prefix").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)
    )
    # Every window of the template's length over the token, the last ones cut at the end of the text.
    starts = probed.select(
        "*",
        F.posexplode_outer(
            F.when(
                F.col("prefix").isNotNull(),
                F.sequence(F.greatest(F.lit(0), F.col("pos") - F.col("length") + 1), F.col("pos")),
            )
        ).alias("shift", "start"),
    )
    block = F.slice("words", F.col("start") + 1, F.col("length"))
    met = starts.withColumn(
        "met",
        F.when(
            (F.col("n_words") - F.col("start") >= F.col("need"))  # length filter
            & (F.size("tokens") - F.col("rank") >= F.col("need"))  # positional filter
            & (F.col("phrase").isNull() | (F.array_join(block, " ") == F.col("phrase"))),
            F.size(F.array_intersect(block, "tokens")),
        ),
    ).withColumn("met", F.when(F.col("met") >= F.col("need"), F.col("met") / F.size("tokens")))
    first = (F.coalesce("pos", F.lit(0)) == 0) & (F.coalesce("shift", F.lit(0)) == 0)
    kept = met.where(first | F.col("met").isNotNull())
    per_row = kept.groupBy("doc_id", "version").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(
            F.collect_set(F.when(F.col("met").isNotNull(), F.struct("template", "start", F.col("met").alias("containment"))))
        ).alias("blocks"),
        # The row at place 0 comes once for each prefix entry of its token.
        (
            F.count_if(first) / F.size(F.collect_set(F.when(first, F.coalesce("template", F.lit(-1)))))
        ).cast("int").alias("copies"),
    )
    return per_row.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy", "copies")


def scan(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """Per row: phrase places, first and last of them, the phrases' labels, all labels, and the best containment."""
    blocks = license_blocks(docs, phrases + notices)
    places = F.filter("blocks", lambda b: b["template"] < len(phrases))
    names = F.array(*[F.lit(t.label) for t in phrases + notices])

    def labels(of):
        return F.array_join(F.sort_array(F.array_distinct(F.transform(of, lambda b: F.get(names, b["template"])))), ",")

    starts = F.transform(places, lambda b: b["start"])
    return blocks.select(
        "doc_id",
        "version",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(places).alias("base_labels"),
        labels(F.col("blocks")).alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0)).alias("score"),
        "blocks",
    )
