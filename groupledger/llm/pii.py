"""Personal data: patterns, and words that give a protected value away.

A protected entity is a value, or what several values have in common: the domain of mail
addresses, the network of addresses, the first digits of cards and phones, the kind. A word
discloses an entity as far as knowing the word tells that the entity is there:
PMI(entity; word) = log(P(entity | word) / P(entity)) against the entity's own information,
log(1 / P(entity)), both over the whole corpus. For P(entity | word) stands the lower end of
its confidence interval, so that a word counts by the texts that speak for it: a word of one
text tells nothing however large the corpus. Words that disclose an entity are generalised
like the values, wherever they stand in a text with that entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import (
    ascii_lower, checkpointed, let, places, running, sliced, stored, table, whole, words,
)

#: The kinds in their order, and what stands for a value of a kind in a cleaned text.
LABELS = {
    "email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]",
}
#: The given patterns. A run is tried once, from its start or from the last match's end,
#: and never given back, which finds the same places in time linear in the text.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word of whole texts: letters, digits and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word discloses an entity if PMI >= THRESHOLD * information of the entity, and if the
#: entity is there with the word more often than not (LEAST); both at the lower end of the
#: interval that is DEVIATIONS wide on each side.
THRESHOLD, LEAST, DEVIATIONS = 0.75, 0.5, 1.645
#: So many texts must speak for a word at least; follows from LEAST and DEVIATIONS.
FEWEST = 3
#: Digits of a card and of a phone that several may have in common.
ISSUER, AREA = 6, 4
#: Pairs of value and word are broadcast up to this many; beyond, they are shuffled.
BROADCAST_PAIRS = 200_000

SPAN = "array<struct<kind:string,entity:string,start:int,end:int>>"
WORDS = "array<struct<term:string,start:int,end:int>>"


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        doubled = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.char_length(digits)), worth),
        F.lit(0), lambda s, x: s + x.cast("int"),
    )
    return total % 10 == 0


def _card(value: Column) -> Column:
    digits = F.regexp_replace(value, r"[\x20-]", "")
    return F.when(F.char_length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def _phone(value: Column) -> Column:
    return F.char_length(F.regexp_replace(value, r"[^0-9]", "")).between(8, 15)


_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def base_spans(text: Column) -> Column:
    """The values of the four kinds, by kind as listed and then by start."""
    digits = lambda x: F.regexp_replace(x, r"[^0-9]", "")
    kinds = (
        ("email", F.contains(text, F.lit("@")), EMAIL, lambda x: F.lit(True), ascii_lower),
        ("ip", text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP,
         lambda x: x.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"), lambda x: x),
        ("card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), CARD, _card, digits),
        ("phone", F.contains(text, F.lit("+")), PHONE, _phone, digits),
    )
    def spans(kind, possible, pattern, holds, plain) -> Column:
        return F.when(possible, F.transform(
            F.filter(places(text, pattern), lambda x: holds(x["value"])),
            lambda x: F.struct(
                F.lit(kind).alias("kind"),
                F.concat(F.lit(f"{kind}:"), plain(x["value"])).alias("entity"),
                x["start"].alias("start"), x["end"].alias("end"),
            ),
        )).otherwise(F.array().cast(SPAN))

    return F.concat(*[spans(*kind) for kind in kinds])


def entities(spans: Column) -> Column:
    """The different entities of a text's values: each value, what it shares with others, and
    its kind."""

    def wider(x: Column) -> Column:
        return (
            F.when(x["kind"] == "email", F.concat(F.lit("email:@"), F.substring_index(x["entity"], "@", -1)))
            .when(x["kind"] == "ip", F.regexp_replace(x["entity"], r"\.[0-9]+$", "."))
            .when(x["kind"] == "card", F.substring(x["entity"], 1, len("card:") + ISSUER))
            .otherwise(F.substring(x["entity"], 1, len("phone:") + AREA))
        )

    return F.array_distinct(F.flatten(F.transform(
        spans, lambda x: F.array(x["entity"], wider(x), x["kind"])
    )))


def surely(together: Column, among: Column) -> Column:
    """The lower end of the (Wilson) confidence interval of a share."""
    share, z = together / among, DEVIATIONS * DEVIATIONS
    spread = F.sqrt(share * (1 - share) / among + F.lit(z) / (4 * among * among))
    return (share + F.lit(z) / (2 * among) - DEVIATIONS * spread) / (1 + F.lit(z) / among)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_PAIRS else df


def _plain(spans: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    ))


def _with_terms(seen: DataFrame, places: DataFrame) -> DataFrame:
    """doc, spans and terms of seen; places has row, start and end of the terms."""
    terms = places.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(
        F.lit("term").alias("kind"), F.col("start"), F.col("end")
    ))).alias("terms"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return seen.select("row", "doc", _plain("spans").alias("spans")).join(
        terms, "row", "left"
    ).select("doc", "spans", F.coalesce("terms", none).alias("terms"))


def read(docs: DataFrame, *keep: str) -> DataFrame:
    """row, doc (a struct of the columns to keep) and spans of every row of docs, stored;
    of texts with values also key, the text's hash, the words that lie in no span, by place,
    hidden, the words of the text that are none of these, and bared, those of these that are
    none of the text's, since a value began in them."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), whole(F.col("text")).alias("body")
    )

    valued = F.size("spans") > 0
    # a step each, as the analyser resolves nested functions by level
    seen = packed.select(
        F.monotonically_increasing_id().alias("row"), "doc", "body",
        base_spans(F.col("body")).alias("spans"),
    ).withColumn("rest", F.when(valued, blanked(F.col("body"), F.col("spans")))).withColumn(
        "words", F.when(valued, places(F.col("rest"), WORD))
    ).withColumn("words", F.coalesce(F.transform("words", lambda w: F.struct(
        ascii_lower(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end")
    )), F.array().cast(WORDS)))
    hidden = F.when(valued, F.array_except(
        words(ascii_lower(F.col("body"))), F.transform("words", lambda w: w["term"])
    )).otherwise(F.array().cast("array<string>"))
    bared = F.when(valued, F.array_except(
        F.transform("words", lambda w: w["term"]), words(ascii_lower(F.col("body")))
    )).otherwise(F.array().cast("array<string>"))
    return stored(seen.select(
        "row", "doc", "spans", "words", F.xxhash64("body").alias("key"), hidden.alias("hidden"),
        bared.alias("bared"),
    ), "pii")


def detect(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row of docs: doc (a struct of the columns to keep), spans of the four kinds and
    terms (kind 'term'), each by start.

    All words outside the values count, over whole texts. P(entity | word) is the share of
    the texts with the word that have the entity; copies of a text with the entity count
    once. A null text counts as empty; repeated rows give a row each; without rows or values
    there are no terms."""
    seen = read(docs, *keep)
    n = float(seen.count())
    known = seen.filter(F.size("spans") > 0)
    own = known.select("row", "key", F.explode(entities(F.col("spans"))).alias("entity"))
    # entities of the same rows have the same terms: they are one class, known by its rows
    values = checkpointed(own.groupBy("entity", "key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("a"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"),
    ).groupBy("entity").agg(F.struct(
        F.sum("n").alias("n"), F.count("*").alias("texts"),
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
    ).alias("rows")).filter((F.col("rows.texts") >= FEWEST) & (F.col("rows.n") < n)))
    classes = own.join(_small(values), "entity").groupBy("row").agg(
        F.collect_set("rows").alias("classes")
    )
    # rows with a word, without those in which it lies in values only
    counts = stored(docs.select(
        F.explode(F.array_distinct(words(ascii_lower(whole(F.col("text")))))).alias("term"),
        F.lit(1).alias("one"),
    ).union(known.select(F.explode("hidden"), F.lit(-1))).union(
        known.select(F.explode("bared"), F.lit(1))
    ).groupBy("term").agg(F.sum("one").alias("n_term")), "words")
    # a word of more rows than this is more often without any entity than with it
    most = values.agg(F.max("rows.n")).first()[0] or 0
    common = counts.filter(F.col("n_term") > most / LEAST).select("term")
    together = known.select("row", "key", F.array_distinct(
        F.transform("words", lambda w: w["term"])
    ).alias("terms")).join(classes, "row").select(
        "row", "key", "classes", F.explode("terms").alias("term")
    ).join(_small(common), "term", "left_anti").select(
        "row", "key", F.explode("classes").alias("rows"), "term"
    )
    pairs = together.groupBy("rows", "term", "key").agg(F.count("*").alias("n")).groupBy(
        "rows", "term"
    ).agg(F.sum("n").alias("n_both"), F.count("*").alias("texts")).filter(F.col("texts") >= FEWEST)
    sure = surely(F.col("texts"), F.col("texts") + F.col("n_term") - F.col("n_both"))
    rate = F.col("rows.n") / n
    flagged = checkpointed(pairs.join(counts, "term").filter(
        (sure >= LEAST) & (F.log(sure / rate) >= THRESHOLD * F.log(1 / rate))
    ).select("rows", "term"))
    terms = together.join(_small(flagged), ["rows", "term"]).select("row", "term").distinct()
    return _with_terms(seen, known.select("row", F.explode("words").alias("w")).select(
        "row", "w.*"
    ).join(terms, ["row", "term"]))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span generalised to its label; overlapping spans get the first
    one's."""
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return _replaced(text, spans, lambda x: label[x["kind"]], lambda x: F.lit(""))


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces for the spans; all places stay."""
    return _replaced(
        text, spans, lambda x: F.repeat(F.lit(" "), x["end"] - x["start"]),
        lambda x: F.repeat(F.lit(" "), F.greatest(x["end"] - x["done"], F.lit(0))),
    )


def _replaced(text: Column, spans: Column, label, rest) -> Column:
    """The text with label of each span, or rest of one that overlaps an earlier one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )))

    def cut(part: Column) -> Column:
        """What goes out for some neighbouring spans; long texts are cut once for all."""
        low, high = part[0]["done"], F.array_max(F.transform(part, lambda x: x["end"]))
        return let(F.substring(text, low + 1, high - low), lambda piece: F.array_join(
            F.transform(part, lambda x: F.when(x["start"] >= x["done"], F.concat(
                F.substring(piece, x["done"] - low + 1, x["start"] - x["done"]), label(x)
            )).otherwise(rest(x))), "",
        ))

    def built(s: Column) -> Column:
        ends = F.transform(s, lambda x: x["end"])
        flat = let(running(ends, lambda a, b: F.greatest(a, b)), lambda done: F.transform(
            s, lambda x, i: F.struct(
                x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"),
                done[i].alias("done"),
            ),
        ))
        return F.concat(
            let(flat, lambda x: F.array_join(F.transform(sliced(x, 256), cut), "")),
            let(F.array_max(ends), lambda last: F.substring(
                text, last + 1, F.char_length(text) - last
            )),
        )

    return let(ordered, lambda s: F.when(F.size(s) > 0, built(s)).otherwise(text))


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with values and disclosing terms generalised in the text; n_chars, where docs
    has it, is that of the new text. Null texts stay null. Other columns are as they were,
    whatever their names."""
    seen = detect(docs, *docs.columns)
    text = seen.select("doc", F.when(
        F.col("doc.text").isNotNull(),
        masked(F.col("doc.text"), F.concat("spans", "terms")),
    ).alias("new"))
    changed = {"text": F.col("new"), "n_chars": F.char_length("new").cast("long")}
    return text.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    ), ",")
    count = lambda kind: F.size(
        F.filter("spans", lambda s: s["kind"] == kind)
    ).cast("long").alias(f"n_{kind}")
    return detect(docs, "doc_id").select(
        "doc.doc_id", *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(said(F.col("spans")), 256).alias("base_sha256"),
        said(F.concat("spans", "terms")).alias("spans"),
    )


#: The same rows in DuckDB.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
low AS (SELECT rid, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS l
        FROM d),
mm AS (
  SELECT rid, 'email' AS kind, 1 AS ord,
         regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS m,
         regexp_split_to_array(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS g
  FROM d WHERE contains(t, '@')
  UNION ALL
  SELECT rid, 'ip', 2, regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
         regexp_split_to_array(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM d
  UNION ALL
  SELECT rid, 'card', 3, regexp_extract_all(t, '[0-9](?:[\x20-]?[0-9])+'),
         regexp_split_to_array(t, '[0-9](?:[\x20-]?[0-9])+') FROM d
  UNION ALL
  SELECT rid, 'phone', 4, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'),
         regexp_split_to_array(t, '\+[0-9][\x20().0-9-]+[0-9]') FROM d WHERE contains(t, '+')),
mk AS (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM mm),
mp AS (SELECT rid, kind, ord, m[k] AS v, regexp_replace(m[k], '[^0-9]', '', 'g') AS dg,
              (coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0))::BIGINT AS s
       FROM mk),
sp AS (SELECT rid, kind, ord, s, s + length(v) AS e,
              kind || ':' || CASE kind WHEN 'email' THEN
                translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                WHEN 'ip' THEN v ELSE dg END AS entity
       FROM mp WHERE CASE kind
         WHEN 'ip' THEN regexp_full_match(v, '({_PART}\.){{3}}{_PART}')
         WHEN 'card' THEN length(dg) BETWEEN 16 AND 19 AND list_sum(list_transform(
           range(1, length(dg) + 1), lambda i: (CASE WHEN i % 2 = 0
             THEN (2 * substr(dg, length(dg) - i + 1, 1)::INT) // 10
                  + (2 * substr(dg, length(dg) - i + 1, 1)::INT) % 10
             ELSE substr(dg, length(dg) - i + 1, 1)::INT END))) % 10 = 0
         WHEN 'phone' THEN length(dg) BETWEEN 8 AND 15 ELSE true END),
isl AS (SELECT rid, min(s) AS s, max(e) AS e FROM (
         SELECT *, sum(apart) OVER (PARTITION BY rid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g
         FROM (SELECT rid, s, e, CASE WHEN s >= coalesce(max(e) OVER (PARTITION BY rid ORDER BY s, e
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS apart
               FROM sp)) GROUP BY rid, g),
cut AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS b FROM isl),
rest AS (SELECT rid, any_value(l) AS whole_text,
                string_agg(substr(l, b + 1, s - b) || repeat(' ', e - s), '' ORDER BY s)
                || substr(any_value(l), max(e) + 1) AS l
         FROM cut JOIN low USING (rid) GROUP BY rid),
wk AS (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (SELECT rid,
         regexp_extract_all(l, '{WORD}') AS m, regexp_split_to_array(l, '{WORD}') AS g FROM rest)),
wp AS (SELECT rid, m[k] AS term,
              (coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0))::BIGINT AS s
       FROM wk),
lv AS (SELECT DISTINCT rid, unnest([entity, kind, CASE kind
         WHEN 'email' THEN 'email:@' || regexp_replace(entity, '^.*@', '')
         WHEN 'ip' THEN regexp_replace(entity, '\.[0-9]+$', '.')
         WHEN 'card' THEN substr(entity, 1, 5 + {ISSUER})
         ELSE substr(entity, 1, 6 + {AREA}) END]) AS entity FROM sp),
en AS (SELECT entity, count(*) AS n_rows, count(DISTINCT t) AS n_texts FROM lv JOIN d USING (rid)
       GROUP BY entity HAVING count(DISTINCT t) >= {FEWEST} AND count(*) < (SELECT count(*) FROM d)),
tm AS (SELECT term, count(*) AS n_term FROM (
         SELECT DISTINCT rid, term FROM wp
         UNION ALL
         SELECT DISTINCT rid, unnest(regexp_extract_all(l, '{WORD}')) FROM low
         WHERE rid NOT IN (SELECT rid FROM sp)) x(rid, term) GROUP BY term),
pr AS (SELECT entity, term, count(*) AS n_both, count(DISTINCT t) AS texts
       FROM (SELECT DISTINCT rid, term FROM wp) JOIN lv USING (rid) JOIN d USING (rid)
       WHERE entity IN (SELECT entity FROM en)
       GROUP BY entity, term HAVING count(DISTINCT t) >= {FEWEST}),
sh AS (SELECT entity, term, n_rows / (SELECT count(*) FROM d)::DOUBLE AS rate,
              (texts + n_term - n_both)::DOUBLE AS among, texts / (texts + n_term - n_both)::DOUBLE AS p
       FROM pr JOIN en USING (entity) JOIN tm USING (term)),
sr AS (SELECT entity, term, rate, (p + {DEVIATIONS} * {DEVIATIONS} / (2 * among) - {DEVIATIONS} * sqrt(
                p * (1 - p) / among + {DEVIATIONS} * {DEVIATIONS} / (4 * among * among)))
              / (1 + {DEVIATIONS} * {DEVIATIONS} / among) AS sure FROM sh),
fl AS (SELECT entity, term FROM sr
       WHERE sure >= {LEAST} AND ln(sure / rate) >= {THRESHOLD} * ln(1 / rate)),
sa AS (SELECT rid, kind, ord, s, e FROM sp
       UNION ALL
       SELECT DISTINCT rid, 'term', 5, s, s + length(term)
       FROM wp JOIN lv USING (rid) JOIN fl USING (entity, term)),
ag AS (SELECT rid, count(*) FILTER (ord = 1) AS n_email, count(*) FILTER (ord = 2) AS n_ip,
              count(*) FILTER (ord = 3) AS n_card, count(*) FILTER (ord = 4) AS n_phone,
              string_agg(kind || ':' || s || ':' || e, ',' ORDER BY ord, s) FILTER (ord < 5) AS b,
              string_agg(kind || ':' || s || ':' || e, ',' ORDER BY ord, s) AS a
       FROM sa GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN ag USING (rid)
"""
