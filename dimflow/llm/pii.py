"""Personal data: direct identifiers by pattern, and terms that give them away by co-occurrence.

Direct identifiers (mail and network addresses, card and phone numbers) are found by pattern in whole texts. Each
distinct value is a protected entity. What else reveals an entity is estimated from the corpus: for a term ``t`` that
stands in texts of entity ``e``, within a few words of it or anywhere, pointwise mutual information ``log(p(e, t) / (p(e) p(t)))`` over documents says how
many bits ``t`` discloses of the ``-log p(e)`` bits that ``e`` holds. A term that discloses nearly all of them in
enough independent places stands for the entity as the identifier itself does: it is generalised to its class, or
removed beyond a second threshold, in every text that has it, whether the entity stands there or not. Counts cover all documents; equal texts count once.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import stored, tidied

#: Order of the kinds in digests; terms that the corpus gives away come last.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# A mail address is found from its "@": the pattern's local part is the run of its characters before, bounded by the
# match before. Looking from the left instead would try a long run again from each of its characters.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never ends inside a run of digits and never begins inside one, as the run's start would do as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for match in _DOMAIN.finditer(text):
        start = at = match.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            end = match.end()
            yield start, end


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            yield match.span()


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right: every second digit from the right counts double."""
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(match.group())) <= 15:
            yield match.span()


FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones), strict=True))


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every direct identifier, by kind and then start; code points, end exclusive."""
    return [(kind, start, end) for kind, finder in FINDERS.items() for start, end in finder(text)]


def _outside(spans: list[tuple[str, int, int]]) -> Callable[[re.Match], bool]:
    """A test whether a word overlaps no identifier."""
    covered: list[list[int]] = []
    for start, end in sorted((start, end) for _, start, end in spans):
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])

    def free(match: re.Match) -> bool:
        i = bisect.bisect_left(covered, match.end(), key=lambda c: c[0]) - 1
        return i < 0 or covered[i][1] <= match.start()

    return free


def words(text: str) -> Iterator[re.Match]:
    """All words of a text outside identifiers."""
    return filter(_outside(find(text)), _WORD.finditer(text))


def nearby(text: str, spans: list[tuple[str, int, int]], window: int) -> list[tuple[str, str, str, int, int]]:
    """(entity, term, context, start, end) of the words within ``window`` words of an identifier, outside identifiers.

    The context is the words around, so that copies of a passage are told from independent mentions. Words are looked
    for beside an identifier only, within 40 characters per word.
    """
    free = _outside(spans)
    found = []
    for kind, start, end in spans:
        before = [m for m in _WORD.finditer(text, max(0, start - 40 * window), start)][-window:]
        after = list(itertools.islice(_WORD.finditer(text, end, end + 40 * window), window))
        words = [m for m in before + after if free(m)]
        context = " ".join(m.group().lower() for m in words)
        entity = f"{kind}:{text[start:end].lower()}"
        found += [(entity, m.group().lower(), context, m.start(), m.end()) for m in words]
    return found


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
NEAR = "array<struct<entity:string,term:string,context:string,start:int,end:int>>"
_NEAR = pa.list_(
    pa.struct([("entity", pa.string()), ("term", pa.string()), ("context", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


TERMS = "array<struct<kind:string,start:int,end:int,action:string>>"
_TERMS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("action", pa.string())]))


def _texts(batch: pa.Array) -> Iterator[str]:
    return (x.as_py() or "" for x in batch)


def direct(docs: DataFrame, *, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the direct identifiers of the whole text; null and empty texts have none."""

    @F.arrow_udf(SPANS)
    @tidied
    def spans_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = ([{"kind": k, "start": a, "end": b} for k, a, b in find(x)] for x in _texts(batch))
            yield pa.array(found, _SPANS, size=len(batch))

    return docs.withColumn(spans, spans_of(F.col(text)))


def mentions(docs: DataFrame, *, text: str = "text", window: int = 5) -> DataFrame:
    """(content, entity, term, context, start, end): words near identifiers; ``content`` is a hash of the text."""

    @F.arrow_udf(NEAR)
    @tidied
    def words_near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = (nearby(x, spans, window) if (spans := find(x)) else [] for x in _texts(batch))
            names = ("entity", "term", "context", "start", "end")
            yield pa.array(([dict(zip(names, row, strict=True)) for row in rows] for rows in found), _NEAR, size=len(batch))

    near = docs.select(F.xxhash64(text).alias("content"), words_near(F.col(text)).alias("near"))
    return near.select("content", F.inline("near"))


def _holding(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(content, term) of all texts that have a word of ``terms``; other words are dropped before the shuffle."""
    found = F.transform(F.regexp_extract_all(F.col(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.lower)
    held = docs.select(F.xxhash64(text).alias("content"), F.explode(F.array_distinct(found)).alias("term"))
    return held.join(terms.select("term").distinct(), "term", "left_semi").select("content", "term").distinct()


def _together(docs: DataFrame, places: DataFrame, text: str) -> DataFrame:
    """(entity, term, both, contexts): in how many texts, and contexts of the entity, each word stands with an entity."""

    @F.arrow_udf("array<string>")
    @tidied
    def words_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(([*{m.group().lower() for m in words(x)}] for x in _texts(batch)), pa.list_(pa.string()), size=len(batch))

    own = docs.select(F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    own = own.join(places.select("content").distinct(), "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
    own = own.select("content", F.explode(words_of("text")).alias("term"))
    return own.join(places, "content").groupBy("entity", "term").agg(
        F.count_distinct("content").alias("both"), F.count_distinct("context").alias("contexts")
    )


def disclosing(
    docs: DataFrame, near: DataFrame, *, text: str = "text", support: int = 5, generalise: float = 0.9, remove: float = 0.98,
    evidence: float = 20.0,
) -> DataFrame:
    """(entity, term, share, action) of the terms in texts of entities that disclose at least ``generalise`` of their bits.

    ``near`` has rows of :func:`mentions`. A term counts only for entities met with it in ``support`` different
    contexts, as fewer mentions say nothing about a corpus: beside the entity, or anywhere in its texts. In the second
    case all words of a text are candidates, so chance must also be ruled out, by ``evidence`` bits over the texts that
    have both. How many texts have these terms comes from one pass over all documents.
    """
    places = near.select("entity", "content", "context").distinct()
    often = places.groupBy("entity").agg(F.count_distinct("context").alias("n")).filter(F.col("n") >= support)
    places = stored(places.join(often.select("entity"), "entity", "left_semi"), "pii-places")
    nothing = places.select("entity", F.lit("").alias("term"), F.lit(0.0).alias("share"), F.lit("").alias("action")).limit(0)
    if places.isEmpty():  # nothing to weigh
        return nothing
    total = docs.select(F.xxhash64(text)).distinct().count()
    with_entity = places.groupBy("entity").agg(F.count_distinct("content").alias("with_entity"))
    held = F.log2(F.lit(float(total)) / F.col("with_entity"))

    def disclosed(with_term: Column) -> Column:
        bits = F.log2(F.col("both") * F.lit(float(total)) / (F.col("with_entity") * with_term))
        return F.when(held > 0, bits / held)

    # A term has at least the texts where it stands near any entity. That bound rules common words out beforehand.
    near_any = near.groupBy("term").agg(F.count_distinct("content").alias("near_any"))
    beside = near.groupBy("entity", "term").agg(F.count_distinct("context").alias("n")).filter(F.col("n") >= support)
    pairs = _together(docs, places, text).filter(F.col("contexts") >= support).join(with_entity, "entity")
    pairs = pairs.join(beside.select("entity", "term", F.lit(True).alias("beside")), ["entity", "term"], "left")
    pairs = pairs.filter(F.coalesce("beside", F.col("both") * held >= evidence)).join(near_any, "term", "left")
    least = F.greatest("both", F.coalesce("near_any", "both"))
    pairs = stored(pairs.withColumn("least", least).filter(disclosed(F.col("least")) >= generalise), "pii-pairs")
    if pairs.isEmpty():
        return nothing
    with_term = _holding(docs, pairs, text).groupBy("term").agg(F.count("*").alias("with_term"))
    weighed = pairs.join(with_term, "term", "left")
    share = disclosed(F.greatest("least", F.coalesce("with_term", "least")))
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    return weighed.select("entity", "term", share.alias("share")).filter(F.col("share") >= generalise).withColumn("action", action)


def detect(docs: DataFrame, *, text: str = "text", spans: str = "spans", extra: str = "terms", window: int = 5, **thresholds) -> DataFrame:
    """``docs`` with all ``spans``, direct ones by kind and start and then disclosing terms, and ``extra``, the terms' actions.

    A term that discloses an entity is marked at every place in every text; of several actions the strictest holds.
    Columns of these names are replaced; other columns and repeated rows pass through. Null and empty texts have no
    spans. Two texts with the same 64-bit hash would share their terms' spans.
    """
    near = stored(mentions(docs, text=text, window=window), "pii-near")
    chosen = stored(disclosing(docs, near, text=text, **thresholds), "pii-terms")
    found = direct(docs, text=text, spans=spans)
    if chosen.isEmpty():
        return found.withColumn(extra, F.array().cast(TERMS))
    strictest = chosen.groupBy("term").agg(F.max(F.col("action") == "remove").alias("removed"))
    by_content = _holding(docs, strictest, text).join(strictest, "term").groupBy(F.col("content").alias("__pii_content")).agg(
        F.collect_list(F.struct("term", "removed")).alias("__pii_terms")  # of one text
    )

    @F.arrow_udf(TERMS)
    @tidied
    def spans_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, terms in batches:
            rows = []
            for x, held in zip(_texts(batch), terms.to_pylist(), strict=True):
                action = {t["term"]: "remove" if t["removed"] else "generalise" for t in held or ()}
                met = ((m, action.get(m.group().lower())) for m in (words(x) if action else ()))
                rows.append([{"kind": TERM, "start": m.start(), "end": m.end(), "action": a} for m, a in met if a])
            yield pa.array(rows, _TERMS)

    found = found.withColumn("__pii_key", F.xxhash64(text))
    joined = found.join(by_content, F.col("__pii_key") == F.col("__pii_content"), "left")
    joined = joined.withColumn(extra, spans_of(F.col(text), F.col("__pii_terms")))
    plain = F.transform(extra, lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    joined = joined.withColumn(spans, F.concat(spans, plain))
    return joined.drop("__pii_key", "__pii_content", "__pii_terms")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(found: DataFrame, *, text: str = "text", spans: str = "spans", extra: str = "terms") -> DataFrame:
    """Rows of :func:`detect` with the text sanitised: identifiers become ``[KIND]``, terms their class or nothing.

    Where spans overlap, the one that starts first stands for all. A null text stays null.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array, spans: pa.Array, terms: pa.Array) -> pa.Array:
        out = []
        for x, own, more in zip(texts.to_pylist(), spans.to_pylist(), terms.to_pylist(), strict=True):
            if x is not None and own:
                removed = {(t["start"], t["end"]) for t in more if t["action"] == "remove"}
                parts, at = [], 0
                for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] < at:
                        continue
                    parts.append(x[at : s["start"]])
                    if s["kind"] != TERM:
                        parts.append(f"[{s['kind'].upper()}]")
                    elif (s["start"], s["end"]) not in removed:
                        parts.append(_term_class(x[s["start"] : s["end"]]))
                    at = s["end"]
                x = "".join([*parts, x[at:]])
            out.append(x)
        return pa.array(out, pa.string())

    return found.withColumn(text, clean(F.col(text), F.col(spans), F.col(extra)))


def _term_class(word: str) -> str:
    return "[NUMBER]" if word.isdigit() else "[NAME]" if word[0].isupper() else "[WORD]"
