"""Personal data, and the terms that give it away, by information-theoretic sanitisation.

Values of a few fixed shapes (addresses of mail and network, card and phone numbers) are the
protected entities.  How far a term discloses an entity is measured over the whole corpus: with
p the shares of documents,

    disclosure(e; t) = PMI(e; t) / IC(e) = log(p(e, t) / (p(e) p(t))) / -log p(e),

which is 1 when the entity follows from the term.  A term that discloses an entity beyond the
threshold is replaced by its generalisation (its first letters) if that discloses little enough,
else removed: wherever it stands, also in documents without the entity.  A pair needs evidence
from different contexts of the entity, so copies of one text prove nothing; and the entity must
follow from the term with a probability whose lower confidence bound reaches a least share, so
that a chance meeting of two rare things proves nothing either, however large the corpus.  All of
it is native expressions, grouped counts and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import before, cut, let, pieces_of, stored, text_of

KINDS = ["email", "ip", "card", "phone"]
#: Runs are possessive and begin at their first character (or where the last match ended): the
#: same matches as plain repetition, in linear time and constant stack on texts of any length.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Usual groupings, for what a plain run loses because it runs on into another number.
GROUPED = {
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
}
#: How probable an entity must be given a term, at least, and the quantile of the bound's error.
LEAST_SHARE, QUANTILE = 1 / 3, 1.96
#: Characters around a mention, on either side, that tell its context from others.
REACH = 80
#: Stands for each character of personal data where words are cut, and is in no text then.
FILL = "\uffff"
TERM = rf"[\p{{L}}\p{{N}}{FILL}]+"
BREAK = rf"[^\p{{L}}\p{{N}}{FILL}]+"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def places(text: Column, pattern: str) -> Column:
    """Start, end (exclusive, in code points) and value of every match, from left to right.

    What stands between the matches and the matches themselves alternate, so lengths add up to
    places.
    """
    def placed(hits: Column) -> Column:
        return let(_starts(hits), lambda starts: F.transform(hits, lambda h, i: F.struct(
            F.get(starts, i).alias("start"), (F.get(starts, i) + h["n"]).alias("end"), h["h"].alias("value"),
        )))

    return let(_hits(text, pattern), placed)


def _hits(text: Column, pattern: str) -> Column:
    """Every match ``h``, its length ``n`` and that of the text since the one before it, ``gap``."""
    return let(
        F.split(text, pattern, -1),
        lambda pieces: F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda h, i: F.struct(h.alias("h"), F.length(h).alias("n"), F.length(F.get(pieces, i)).alias("gap")),
        ),
    )


def _starts(hits: Column) -> Column:
    """Where each of the matches begins: what the ones before it and all gaps add up to."""
    upto = before(F.transform(hits, lambda h: h["gap"] + h["n"]), lambda a, x: a + x, F.lit(0))
    return F.zip_with(hits, upto, lambda h, at: h["gap"] + at)


def _ends_before(spans: Column) -> Column:
    """For each of the sorted spans, where the spans before it end at the latest."""
    return before(F.transform(spans, lambda s: s["end"]), F.greatest, F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits has a sum by Luhn's rule that ends in 0."""
    values = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, F.ascii(d) - 48)
        .otherwise(2 * (F.ascii(d) - 48) - F.when(F.ascii(d) > 52, 9).otherwise(0)),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    count = F.length(digits(value))
    if kind == "card":
        return count.between(16, 19) & luhn(digits(value))
    return count.between(8, 15)


def _entity(kind: str, value: Column) -> Column:
    plain = {"email": F.lower(value), "ip": value}.get(kind, digits(value))
    return F.concat(F.lit(kind + ":"), plain)


def spans_of(text: Column) -> Column:
    """Spans by kind as listed, then start: kind, start, end, entity, base.

    ``base`` marks the matches of the plain patterns; cards and phones in their usual grouping
    that overlap none of them are added, so a number beside another one isn't lost.
    """
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,entity:string,base:boolean>>")
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}

    def hits(kind: str, pattern: str, base: bool) -> Column:
        held = F.filter(places(text, pattern), lambda s: _holds(kind, s["value"]))
        return F.transform(held, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            _entity(kind, s["value"]).alias("entity"), F.lit(base).alias("base"),
        ))

    def merged(every: Column) -> Column:
        """Of the sorted spans of one kind the base ones, and others that overlap none of those."""
        far = F.lit(2**31 - 1)
        done = before(F.transform(every, lambda s: F.when(s["base"], s["end"]).otherwise(0)), F.greatest, F.lit(0))
        next_ = F.reverse(before(
            F.transform(F.reverse(every), lambda s: F.when(s["base"], s["start"]).otherwise(far)), F.least, far
        ))
        return let(done, lambda d: let(next_, lambda x: F.filter(
            every, lambda s, i: s["base"] | ((F.get(d, i) <= s["start"]) & (F.get(x, i) >= s["end"]))
        )))

    def of_kind(kind: str) -> Column:
        plain = hits(kind, PATTERNS[kind], True)
        if kind in GROUPED:
            # Of one kind, so they are sorted by their start.
            every = F.array_sort(F.concat(plain, hits(kind, GROUPED[kind], False)))
            plain = let(every, merged)
        return F.when(may.get(kind, text.rlike(r"[0-9][\x20.-]?[0-9]")), plain).otherwise(empty)

    return F.concat(*map(of_kind, KINDS))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with ``FILL`` for each character of the spans, so all places stay the same."""
    plain = F.translate(text, FILL, " ")

    def filled(marks: Column) -> Column:
        return let(pieces_of(plain), lambda pieces: let(_ends_before(marks), lambda upto: F.concat(
            F.array_join(F.transform(marks, lambda s, i: F.concat(
                cut(pieces, F.get(upto, i), s["start"]),
                F.repeat(F.lit(FILL), F.greatest(s["end"] - F.greatest(F.get(upto, i), s["start"]), F.lit(0))),
            )), ""),
            cut(pieces, F.array_max(F.transform(marks, lambda s: s["end"])), F.length(plain)),
        )))

    sorted_marks = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    )
    return F.when(F.size(spans) > 0, let(sorted_marks, filled)).otherwise(plain)


def terms_of(text: Column, spans: Column) -> Column:
    """The different whole words (lower case) of a text that touch no personal data."""
    own = F.filter(
        F.array_distinct(F.split(masked(text, spans), BREAK, -1)),
        lambda w: (w != "") & ~F.contains(w, F.lit(FILL)),
    )
    return F.array_distinct(F.transform(own, F.lower))


def term_places(text: Column, spans: Column, held: Column) -> Column:
    """Start, end and action of every word of ``text`` whose term is in ``held`` (term, action)."""
    names = F.transform(held, lambda h: h["term"])

    def placed(hits: Column) -> Column:
        words = F.zip_with(hits, _starts(hits), lambda h, at: F.struct(
            at.alias("start"), (at + h["n"]).alias("end"),
            F.array_position(names, F.lower(h["h"])).cast("int").alias("which"),
        ))
        return F.transform(F.filter(words, lambda w: w["which"] > 0), lambda w: F.struct(
            w["start"].alias("start"), w["end"].alias("end"),
            F.get(held, w["which"] - 1)["action"].alias("action"),
        ))

    return let(masked(text, spans), lambda m: let(_hits(m, TERM), placed))


def generalised(term: Column) -> Column:
    """A term's generalisation: its first three letters."""
    return F.concat(F.substring(term, 1, 3), F.lit("*"))


def found(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Stored rows: ``row``, ``id`` (one for each row), ``spans``, ``context`` of the mentions, ``text``.

    ``keep`` names the columns to carry in ``row``, all by default.  A null text counts as the
    empty one and has no spans.
    """
    names = docs.columns if keep is None else keep
    whole = text_of(text)

    def context(spans: Column) -> Column:
        return let(F.length(whole), lambda size: let(pieces_of(whole), lambda pieces: F.transform(
            spans, lambda s: F.struct(s["entity"].alias("entity"), F.xxhash64(cut(
                pieces, F.greatest(s["start"] - REACH, F.lit(0)), F.least(s["end"] + REACH, size)
            )).alias("place")),
        )))

    marks = let(spans_of(whole), lambda spans: F.struct(
        spans.alias("spans"), F.when(F.size(spans) > 0, context(spans)).alias("context"),
    ))
    beside = [] if text in names else [whole.alias("text")]
    rows = stored(docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.monotonically_increasing_id().alias("id"), marks.alias("marks"), *beside,
    ), "sanitise-found")
    own = F.col("text") if beside else F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    return rows.select("row", "id", "marks.spans", "marks.context", own.alias("text"))


def disclosing(
    docs: DataFrame, marked: DataFrame, text: str = "text", threshold: float = 0.8,
    least_contexts: int = 2,
) -> DataFrame:
    """Pairs of entity and term whose disclosure reaches ``threshold``; what becomes of the term.

    Counts are over all documents: those with the entity, with the term, and with both anywhere.
    ``least_contexts`` is in how many different contexts of the entity a pair must have been seen.
    The share of the term's documents that have the entity must lie above ``LEAST_SHARE`` by the
    lower bound of Wilson's interval: two of two documents do, two of nineteen don't.
    Entities and terms are left out before they are paired only where no pair of them could reach
    the threshold: both occur together at most as often as either.  Columns: entity, term,
    disclosure, action ("generalise" or "remove").
    """
    n = marked.count()
    total = F.lit(float(max(n, 1)))
    mentions = (
        marked.filter(F.size("spans") > 0).select("id", F.explode("context").alias("c"))
        .groupBy("id", "c.entity").agg(F.min("c.place").alias("place"))
    )
    of_entity = (
        mentions.groupBy("entity", "place").agg(F.count("*").alias("n"))
        .groupBy("entity").agg(F.sum("n").alias("ne"), F.count("*").alias("contexts"))
        .filter(F.col("contexts") >= least_contexts).select("entity", "ne")
    )
    known = stored(mentions.join(of_entity, "entity"), "sanitise-mentions")
    own = terms_of(F.col("text"), F.col("spans"))
    every = let(own, lambda w: F.array_distinct(F.concat(w, F.transform(w, generalised))))
    of_term = marked.select(F.explode(every).alias("term")).groupBy("term").agg(F.count("*").alias("nw"))
    ic = F.log(total / F.col("ne"))
    most = known.groupBy("id").agg(F.max("ne").alias("most"))
    here = marked.join(most, "id").select("id", "most", F.explode(every).alias("term"))
    may = F.log(total / F.col("nw")) >= threshold * F.log(total / F.col("most")) - 1e-9
    here = here.join(of_term, "term").filter(may).select("id", "term", "nw")
    both = (
        here.join(known, "id").filter(F.log(total / F.col("nw")) >= threshold * ic - 1e-9)
        .groupBy("entity", "term", "place")
        .agg(F.count("*").alias("n"), F.max("ne").alias("ne"), F.max("nw").alias("nw"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("nt"), F.count("*").alias("contexts"), F.max("ne").alias("ne"), F.max("nw").alias("nw"))
        .filter(F.col("contexts") >= least_contexts)
    )
    share, nw, z = F.col("nt") / F.col("nw"), F.col("nw").cast("double"), F.lit(QUANTILE)
    surely = (
        share + z * z / (2 * nw) - z * F.sqrt(share * (1 - share) / nw + z * z / (4 * nw * nw))
    ) / (1 + z * z / nw)
    both = both.filter(surely >= LEAST_SHARE)
    pmi = F.log(F.col("nt") * total / (F.col("ne") * F.col("nw")))
    scored = stored(
        both.select("entity", "term", F.coalesce(F.try_divide(pmi, ic), F.lit(0.0)).alias("disclosure"))
        .filter(F.col("disclosure") >= threshold),
        "sanitise-disclosure",
    )
    whole = scored.filter(~F.col("term").endswith("*"))
    # A generalisation is wherever its terms are: if it is not here, it discloses too little.
    general = scored.filter(F.col("term").endswith("*")).select(
        "entity", F.col("term").alias("general"), F.lit(True).alias("discloses")
    )
    return (
        whole.withColumn("general", generalised(F.col("term")))
        .join(general, ["entity", "general"], "left")
        .select(
            "entity", "term", "disclosure",
            F.when(F.col("discloses").isNull() & (F.length("term") > 3), "generalise")
            .otherwise("remove").alias("action"),
        )
    )


def term_spans(marked: DataFrame, pairs: DataFrame) -> DataFrame:
    """``marked`` with ``terms`` (start, end, action): every occurrence of a disclosing term in
    any text, whether or not the entity is there."""
    passing = stored(pairs.groupBy("term").agg(F.max("action").alias("action")), "sanitise-terms")
    held = (
        marked.select("id", F.explode(terms_of(F.col("text"), F.col("spans"))).alias("term"))
        .join(passing, "term")
        .groupBy("id").agg(F.collect_list(F.struct("term", "action")).alias("held"))
    )
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    return marked.join(held, "id", "left").withColumn("terms", F.when(
        F.col("held").isNotNull(), term_places(F.col("text"), F.col("spans"), F.col("held"))
    ).otherwise(none)).drop("held")


def marked_spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, ``spans`` of personal data, ``terms`` that disclose some (both may be empty), ``text``."""
    rows = found(docs, text, keep)
    return term_spans(rows, disclosing(docs, rows, text)).select("row", "spans", "terms", "text")


def cleaned(text: Column, spans: Column, terms: Column) -> Column:
    """``text`` with spans as "[KIND]", terms as their generalisation or nothing.

    Of overlapping spans the one that starts first stands for all; personal data before terms.
    """
    def joined(marks: Column, pieces: Column) -> Column:
        return let(_ends_before(marks), lambda upto: F.concat(
            F.array_join(F.transform(marks, lambda m, i: F.when(
                m["start"] >= F.get(upto, i), F.concat(cut(pieces, F.get(upto, i), m["start"]), m["by"])
            ).otherwise("")), ""),
            cut(pieces, F.array_max(F.transform(marks, lambda m: m["end"])), F.length(text)),
        ))

    def marked(pieces: Column) -> Column:
        own = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(0).alias("rank"), s["end"].alias("end"),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"),
        ))
        told = F.transform(terms, lambda t: F.struct(
            t["start"].alias("start"), F.lit(1).alias("rank"), t["end"].alias("end"),
            F.when(t["action"] == "generalise", generalised(cut(pieces, t["start"], t["start"] + 3)))
            .otherwise("").alias("by"),
        ))
        return let(F.array_sort(F.concat(own, told)), lambda marks: joined(marks, pieces))

    return F.when(F.size(spans) + F.size(terms) > 0, let(pieces_of(text), marked)).otherwise(text)


def sanitised(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with personal data and disclosing terms taken out of ``text``.

    Rows without either stay as they are, nulls included.  ``length`` names a column to set to
    the new number of code points.  Extra columns of any name are kept.
    """
    changed = (F.size("spans") > 0) | (F.size("terms") > 0)
    rows = marked_spans(docs, text).select(
        "row", F.when(changed, cleaned(F.col("text"), F.col("spans"), F.col("terms"))).alias("new")
    )

    def column(c: str) -> Column:
        kind, old = docs.schema[c].dataType, F.col("row")[c]
        out = {text: F.col("new"), length: F.length("new")}.get(c)
        return (old if out is None else F.coalesce(out.cast(kind), old)).alias(c)

    return rows.select(*(column(c) for c in docs.columns))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")
