"""Personal data: base patterns, and information-theoretic sanitisation of the terms around them.

Protected entities are the values the base patterns find (addresses, numbers). A term that keeps appearing next to one
entity and hardly anywhere else reveals it even after the value itself is gone. Corpus counts estimate this: with N
documents, ``n_c`` that hold the entity, ``n_t`` that hold the term, and ``n_ct`` that hold the term in a context of the
entity (the ``REACH`` terms before and after an occurrence), the pointwise mutual information
``log2(N n_ct / (n_c n_t))`` is set against the information content of the entity, ``log2(N / n_c)``. All four count
documents, copies included. A term discloses the entity when its information is at least ``1 / ALPHA`` of the content and,
whatever the size of the corpus, it stands beside the entity in a share of its documents whose lower confidence limit is
``DISCLOSED`` (Wilson's, one-sided 95 %); on ``SUPPORT`` different contexts at least. For support and limit copies of one
context count once. Disclosing terms are marked wherever they occur, in
every document of the corpus, beside the entity or without it, and are generalised to a placeholder.

All counts cover all documents. Contexts exist only around entities; the document counts of terms are taken for
terms with enough support. No table of terms is broadcast unless Spark finds it small.

Defined results: null text is empty; rows with null or repeated ids give one row each and count as a document each; other columns are ignored. Numbers of any length are handled without conversion.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_text, scratch_table, text_groups

KINDS = ("email", "ip", "card", "phone")
REACH = 4      # terms on each side of an entity
SUPPORT = 3    # distinct contexts
ALPHA = 1.25   # 1: only terms that never occur without the entity
DISCLOSED = 1 / 3
CONFIDENCE = 1.645
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

# fixed values: the base patterns
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# (possessive, and begun at whole runs of digits: the same matches in linear time)
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TERM = regex.compile(r"[\p{L}\p{N}]+")
JAVA_NOT_TERM = r"[^\p{L}\p{N}]+"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` (linear also where long runs hold none)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base findings, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def contexts(text: str) -> list[tuple[int, int, list[str]]]:
    """``(entity, context, terms)`` of every base finding: hashes of the value and of the terms around it."""
    spans = base_spans(text)
    if not spans:
        return []
    hidden = [(a, b) for a, _, b in spans]
    terms = []
    k = 0
    for m in TERM.finditer(text):
        while k < len(hidden) and hidden[k][1] <= m.start():
            k += 1
        inside = any(a < m.end() and m.start() < b for a, b in hidden[k:k + 4])
        if not inside and not m.group().isdigit():
            terms.append((m.start(), m.group().lower()))
    out, at = [], 0
    for a, kind, b in spans:
        while at < len(terms) and terms[at][0] < a:
            at += 1
        near = [t for _, t in terms[max(0, at - REACH):at + REACH]]
        out.append((hash64(f"{KINDS[kind]}:{text[a:b].lower()}"), hash64(" ".join(near)), sorted(set(near))))
    return out


def occurrences(docs: DataFrame) -> DataFrame:
    """``document, entity, context, terms`` of every base finding; ``document`` numbers the rows of the corpus."""
    names = ["document", "entity", "context", "terms"]

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, texts in text_groups(batch):
                rows = [(number + k, *c) for k, t in enumerate(texts) for c in contexts(t)]
                number += len(texts)
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.mapInArrow(run, "document long, entity long, context long, terms array<string>")


def document_terms() -> Column:
    """Distinct terms of ``text``, cut before they are lowered as in :func:`contexts`."""
    return F.array_distinct(F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), JAVA_NOT_TERM), F.lower))


def disclosing_terms(docs: DataFrame, found: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``entity, term, information`` of the terms whose mutual information reaches the threshold."""
    held = found.select("document", "entity", "context", F.explode("terms").alias("term"))
    joint = (held.groupBy("entity", "term").agg(F.count_distinct("document").alias("n_ct"), F.count_distinct("context").alias("support"))
             .where(F.col("support") >= support))
    joint = scratch_table(joint, "joint")
    # counted before the join: a frequent term then meets the candidates as one row
    n_t = docs.select(F.explode_outer(document_terms()).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n_c = found.select("document", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    n = docs.agg(F.count("*")).scalar()
    table = (joint.join(n_t, "term", "left").join(n_c, "entity")
             .withColumn("n_t", F.greatest(F.coalesce("n_t", F.lit(0)), "n_ct"))
             .withColumn("n", F.greatest(n, "n_t", "n_c")))
    pmi = F.log2(F.col("n") * F.col("n_ct") / (F.greatest("n_c", "n_ct") * F.col("n_t")))
    content = F.log2(F.col("n") / F.greatest("n_c", "n_ct"))
    # as many trials as the contexts are worth: copies tell nothing new
    share, trials, z = F.col("n_ct") / F.col("n_t"), F.col("support") * F.col("n_t") / F.col("n_ct"), F.lit(CONFIDENCE)
    spread = F.sqrt(share * (1 - share) / trials + z * z / (4 * trials * trials))
    limit = (share + z * z / (2 * trials) - z * spread) / (1 + z * z / trials)
    return (table.withColumn("information", pmi).where(content > 0).where(F.col("information") * alpha >= content).where(limit >= DISCLOSED)
            .select("entity", "term", "information"))


def marked(text: str, terms: set[str]) -> list[tuple[int, int, int]]:
    """Base spans and the spans of disclosing terms (kind number ``len(KINDS)``), in order."""
    spans = base_spans(text)
    if terms:
        spans += [(m.start(), len(KINDS), m.end()) for m in TERM.finditer(text) if m.group().lower() in terms]
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, 'term')[k]}:{a}:{b}" for a, k, b in spans)


def sanitised(text: str, terms: set[str]) -> str:
    """The text with every span generalised; spans that overlap become the placeholder of the first."""
    out, done = [], 0
    for a, k, b in marked(text, terms):
        if a >= done:
            out += [text[done:a], GENERAL[(*KINDS, "term")[k]]]
        done = max(done, b)
    return "".join(out) + text[done:]


def with_terms(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) and the column ``name``: what has to be marked beside the base findings."""
    pairs = docs.select("doc_id", "text")
    found = scratch_table(occurrences(pairs), "entities")
    flagged = scratch_table(disclosing_terms(pairs, found).select("term").distinct(), "flagged")
    # rows without an id go by their text; where keys meet, the terms of both are flagged terms and fit either text
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    by = fresh(docs, "term_key")
    per_doc = (docs.select(key.alias(by), F.explode(document_terms()).alias("term")).join(flagged, "term")
               .groupBy(by).agg(F.collect_set("term").alias(name)))  # bounded by the text's own terms
    per_doc = scratch_table(per_doc, "terms")
    return docs.withColumn(by, key).join(per_doc, by, "left").drop(by)


def _map(df: DataFrame, marks: str, names: list[str], schema: str, make_row) -> DataFrame:
    """Columns computed from ``text`` and its terms to mark (column ``marks``), beside all the others."""
    keep = [c for c in df.columns if c not in ("text", marks) and c not in names]
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[part.split()[-1]] for part in schema.split(",")]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)

    def run(batches):
        for batch in batches:
            for at, texts in text_groups(batch):
                terms = batch.column(marks).slice(at, len(texts)).to_pylist()
                rows = [make_row(t, set(x or ())) for t, x in zip(texts, terms)]
                new = [pa.array(c, k) for c, k in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, len(texts)) for c in keep] + new,
                                                 names=keep + names)

    return df.mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    def row(text: str, terms: set[str]):
        base = base_spans(text)
        counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
        return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(marked(text, terms)))

    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    schema = ", ".join([*(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return _map(with_terms(id_text(docs, id_col, text_col), "marks"), "marks", names, schema, row)


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with every marked span generalised; same columns, ``n_chars`` (if there) counted anew.

    A null text stays null.
    """
    columns = docs.columns
    missing, marks, new = fresh(docs, "text_missing"), fresh(docs, "text_marks"), fresh(docs, "text_sanitised")
    typed = docs.withColumn(missing, F.col("text").isNull())
    out = _map(with_terms(typed, marks), marks, [new], f"{new} string", lambda text, terms: (sanitised(text, terms),))
    out = out.withColumn("text", F.when(~F.col(missing), F.col(new)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
