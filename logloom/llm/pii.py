"""Personal data, and the words around it that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers by fixed rules.
Every distinct value found that way is a protected entity. Information theory decides
what else to hide: over the whole corpus, a term's co-occurrence with an entity (in the
``reach`` words on either side of its mentions) is compared with how often the term
occurs at all. The pointwise mutual information PMI(entity; term) is what the term tells
about the entity, IC(entity) = -log2 p(entity) is all there is to tell; a term that tells
more than ``disclose`` of it is generalised, more than ``remove`` of it removed, wherever
it stands around that entity. Equal contexts and equal texts count once, so that copies of
one text make its words neither telling nor common.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.batches import free_name, small_batches
from logloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WORDS = r"\p{L}+"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can start inside a run of digits of which an earlier start failed, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SPAN = "struct<kind:string,start:int,end:int>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every ``@`` with the longest local part before it, as the leftmost match would have it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; null has none."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def mentions(text: str, spans: list[tuple[str, int, int]], reach: int) -> list[dict]:
    """The words around every base span: entity, context and (term, start, end)."""
    import regex

    taken = sorted((a, b) for _, a, b in spans)
    words, at = [], 0
    for m in regex.finditer(WORDS, text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            words.append((m[0].lower(), *m.span()))
    starts = [w[1] for w in words]
    out = []
    from bisect import bisect_left

    for kind, a, b in spans:
        i = bisect_left(starts, a)
        near = words[max(0, i - reach) : i] + words[i : i + reach]
        entity = kind + ":" + "".join(c for c in text[a:b].lower() if c.isalnum() or c in "@.")
        out.append(
            {
                "entity": entity,
                "context": " ".join(w[0] for w in near),
                "terms": [{"term": w, "start": s, "end": e} for w, s, e in near],
            }
        )
    return out


def _extract(reach: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = base_spans(text)
                found = mentions(text, spans, reach) if spans else []
                rows.append(([{"kind": k, "start": a, "end": b} for k, a, b in spans], found))
            yield pd.DataFrame(rows, columns=["spans", "mentions"])

    kind = f"spans array<{SPAN}>, mentions array<struct<entity:string,context:string,terms:array<struct<term:string,start:int,end:int>>>>"
    return F.pandas_udf(run, kind)


def telling_terms(mentions: DataFrame, docs: DataFrame, text: str, reach: int, disclose: float, remove: float, support: int) -> DataFrame:
    """(entity, term, removed): terms that tell more than ``disclose`` of an entity.

    ``mentions`` has entity, context and terms. A pair counts in at least ``support``
    different contexts. Words are counted over the different texts of ``docs``.
    """
    contexts = mentions.select("entity", "context").distinct()
    many = contexts.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") >= support)
    terms = contexts.select("entity", F.explode(F.array_distinct(F.split("context", " "))).alias("term")).filter("term <> ''")
    pairs = terms.groupBy("entity", "term").agg(F.count("*").alias("n_both")).filter(F.col("n_both") >= support)
    pairs = materialize(pairs.join(many, "entity"))
    texts = docs.select(F.lower(F.col(text)).alias("text")).distinct()
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(WORDS), 0)).alias("term"))
    # words that are no candidates count as one
    known = pairs.select(F.col("term").alias("known")).distinct()
    marked = words.join(known, F.col("term") == F.col("known"), "left")
    counts = materialize(marked.groupBy(F.col("known").alias("term")).agg(F.count("*").alias("n_term")))
    total = counts.agg(F.sum("n_term")).first()[0] or 1
    # Of the n_entity * 2 * reach words around the entity, n_both are the term; of all words, n_term.
    pmi = F.log2(F.col("n_both") * float(total) / (F.col("n_entity") * float(2 * reach) * F.greatest("n_term", "n_both")))
    told = pmi / F.log2(float(total) / F.col("n_entity"))
    judged = pairs.join(counts, "term").withColumn("told", told)
    return judged.filter(F.col("told") > disclose).select("entity", "term", (F.col("told") > remove).alias("removed"))


def find_personal(
    docs: DataFrame,
    text: str = "text",
    out: str = "personal",
    reach: int = 5,
    disclose: float = 0.5,
    remove: float = 0.75,
    support: int = 3,
) -> DataFrame:
    """``docs`` with ``out``: base spans and those of disclosing terms, (kind, start, end, removed).

    Spans are in code points, end exclusive, by start and then kind. Null and empty texts
    have none. Rows stay as they are, repeated ids included. They find their spans in the
    stored table by a digest of the text, salted with the row's columns so that copies of
    a text spread; unlike a row number it is the same however often, and on however many
    executors, ``docs`` is read. A column called ``out`` is replaced.
    Terms are judged over all texts of ``docs``, equal ones once; ties cannot arise, thresholds are strict.
    """
    small_batches(docs.sparkSession)
    row, found = free_name(docs, "row_number"), free_name(docs, "found")
    kept = docs.drop(out) if out in docs.columns else docs
    salt = F.xxhash64(*[F.col(f"`{c}`") for c, kind in kept.dtypes if "map<" not in kind and "variant" not in kind])
    numbered = kept.withColumn(row, F.unhex(F.sha2(F.concat_ws(" ", salt.cast("string"), F.col(text)).cast("binary"), 256)))
    spotted = numbered.select(F.col(row).alias("row"), _extract(reach)(F.col(text)).alias("x")).select("row", "x.*")
    spotted = materialize(spotted.filter(F.size("spans") > 0))
    single = spotted.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    telling = telling_terms(single, docs, text, reach, disclose, remove, support)
    placed = single.select("row", "entity", F.explode("terms").alias("t")).select("row", "entity", "t.*")
    extra = placed.join(telling, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("removed").alias("removed"))
    extra = extra.groupBy("row").agg(
        F.collect_list(F.struct(F.lit(TERM).alias("kind"), "start", "end", "removed")).alias("terms")
    )
    base = F.transform(
        "spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("removed"))
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int,removed:boolean>>")
    both = spotted.select("row", "spans").dropDuplicates(["row"]).join(extra, "row", "left").select(
        F.col("row").alias(row), F.concat(base, F.coalesce("terms", none)).alias(found)
    )
    rank = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    key = lambda s: F.struct(s["start"].alias("a"), F.array_position(rank, s["kind"]).alias("b"), s.alias("s"))
    ordered = F.transform(F.array_sort(F.transform(F.coalesce(found, none), key)), lambda x: x["s"])
    return numbered.join(both, row, "left").withColumn(out, ordered).drop(row, found)


def hidden(text: str | None, spans) -> str | None:
    """The text with base spans named by their kind, telling terms generalised or removed.

    Of overlapping spans the first (longest, if they start together) covers the others.
    """
    if text is None or not len(spans):
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            out.append(text[at : s["start"]])
            out.append("" if s["removed"] else f"[{s['kind'].upper()}]")
        at = s["end"]
    return "".join(out) + text[at:]


def _hide(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([hidden(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with all spans of ``find_personal`` hidden in the text; no row goes, columns stay as they are."""
    spans = free_name(docs, "personal")
    found = find_personal(docs, text, spans, **options)
    clean = F.when(F.size(spans) > 0, F.pandas_udf(_hide, "string")(F.col(text), F.col(spans))).otherwise(F.col(text))
    return found.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns])


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of every kind, a digest of the base spans, and all spans of every document."""
    found = find_personal(docs.select("doc_id", "text"))
    joined = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    base = F.filter("personal", lambda s: s["kind"] != TERM)
    of_kind = lambda k: F.size(F.filter("personal", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = map(of_kind, KINDS)
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal")).alias("spans"),
        of_kind(TERM),
    )
