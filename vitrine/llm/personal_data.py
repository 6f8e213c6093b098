"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities train a span classifier.

1. Every text is searched once. Base spans (mail and IP addresses, card and phone numbers that match their pattern and pass
   its test) stay as they are. Looser patterns propose more candidates around and inside what the base patterns miss:
   disguised or international mail addresses, IPv6 and disguised IPv4, card numbers glued to other digits or grouped
   by other signs, phone numbers without a plus or followed by other numbers.
2. On every candidate regex, gazetteer and context labelers vote for (+1), against (-1) or not at all (0).
3. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, per kind; base
   spans are known to be right. Patterns are at most ``3 ** len(LABELERS)`` per kind, so they come to the driver.
4. A logistic regression on shape, neighbours and context learns from the posteriors of all candidates of all documents.
   It accepts further candidates, those that no base span overlaps.

Null texts are empty; each row is its own document, whatever its doc_id; repeated rows get equal results and count as often as they
occur; empty tables give no rows, other columns are not read. Texts are searched whole, with patterns that are
linear in their length. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import ipaddress
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm.core import stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "validity", "shape", "gazetteer", "cue", "counter-cue", "isolation")
ACCEPT = 0.9  # probability from which a candidate is a span
ROUNDS = 60

# Patterns of the contract, written so that no run is tried twice.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Gazetteers.
TOP_DOMAINS = frozenset(
    "com org net edu gov int mil info biz io co ai app dev me tv eu us uk ca au nz ie de at ch fr be nl lu es pt it gr pl cz sk hu ro "
    "bg se no dk fi is ee lv lt ru ua tr il in cn jp kr tw hk sg br mx ar cl za example test".split())
COUNTRY_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 "
    "98 212 213 216 218 220 234 254 256 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 380 381 385 386 420 421 852 855 880 886 "
    "961 962 963 964 965 966 968 971 972 973 974 977 994 995 998".split())
CUES = {
    "email": ("mail", "contact", "courriel", "correo", "kontakt", "write to", "@"),
    "ip": ("ip", "host", "server", "address", "adresse", "servidor", "login from", "client"),
    "card": ("card", "carte", "karte", "tarjeta", "visa", "mastercard", "amex", "credit", "kredit", "debit", "pan"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "cell", "whatsapp", "appel", "anruf", "rufen", "handy", "movil", "móvil", "llam"),
}
COUNTER_CUES = ("token", "password", "passwd", "secret", "sha", "md5", "uuid", "isbn", "issn", "version", "serial", "order", "invoice", "build", "doi", "=", "#", "v.")

# Looser proposals.
AT = re.compile(r"\x20?[(\[{]\x20?(?:at|@)\x20?[)\]}]\x20?", re.I)
SPELLED_DOMAIN = re.compile(r"[^\W_][\w-]*+(?:(?:\.|\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?)[^\W_][\w-]*+)++", re.I)
WIDE_DOMAIN = re.compile(r"@[^\W_][\w-]*+(?:\.[^\W_][\w-]*+)++")
SPELLED_QUAD = re.compile(r"(?<![\w.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}+){3}(?![\w])")
SIXES = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
NUMBER = re.compile(r"(?<![\w.,+-])[0-9]{13,19}+(?![\w]|[.,-][0-9])")
GROUPED = re.compile(r"(?<![\w.,+-])(?:[0-9]{4}([\x20. -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([\x20. -])[0-9]{6}\2[0-9]{5})(?![\w]|[.,-][0-9])")
CALLS = re.compile(
    r"(?<![\w.+-])(?:\+1[\x20.-]?)?(?:\([2-9][0-9]{2}\)[\x20.-]?|[2-9][0-9]{2}[.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w])"
    r"|(?<![\w.+])(?:\+|00)[1-9][0-9]{0,2}(?:[\x20.-]\(?0?\)?[\x20.-]?[0-9]{1,4}(?![0-9])(?:[\x20.-][0-9]{2,4}(?![0-9])){2,4})"
    r"|(?<![\w.+-])0[1-9](?:([\x20.-])[0-9]{2})(?:\1[0-9]{2}){3}(?![\w])"
    r"|(?<![\w.+-])0[1-9][0-9]{1,3}[\x20/-][0-9]{5,8}(?![\w])")
ANY_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def small(number: str) -> bool:
    """A run of digits that is at most 255."""
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or 0) <= 255


def _left_run(text: str, end: int, least: int, one) -> int:
    while end > least and one(text[end - 1]):
        end -= 1
    return end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) as the contract has them, by kind and start."""
    out, least, at = [], 0, text.find("@")
    while at >= 0:
        # The sign is in no local part, so a match starts where the run before it does.
        start = _left_run(text, at, least, LOCAL.match)
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
        least = domain.end() if domain else at + 1
        at = text.find("@", least)
    if ANY_DIGIT.search(text):
        for m in QUAD.finditer(text):
            if all(map(small, m.group().split("."))):
                out.append((1, *m.span()))
        for m in DIGITS.finditer(text):
            number = only_digits(m.group())
            if 13 <= len(number) <= 19 and luhn(number):
                out.append((2, *m.span()))
        if "+" in text:
            for m in PLUS.finditer(text):
                if 9 <= len(only_digits(m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the looser patterns find."""
    out = []
    wide = lambda c: c.isalnum() or c in "._%+-"
    least = 0
    for m in AT.finditer(text) if any(c in text for c in "([{") else ():
        domain, start = SPELLED_DOMAIN.match(text, m.end()), _left_run(text, m.start(), least, wide)
        if domain and start < m.start():
            out.append((0, start, domain.end()))
        least = domain.end() if domain else m.end()
    least, at = 0, text.find("@")
    while at >= 0:
        domain, start = WIDE_DOMAIN.match(text, at), _left_run(text, at, least, wide)
        if domain and start < at:
            out.append((0, start, domain.end()))
        least = at + 1
        at = text.find("@", least)
    if ANY_DIGIT.search(text):
        out += [(1, *m.span()) for m in SPELLED_QUAD.finditer(text)]
        out += [(2, *m.span()) for p in (NUMBER, GROUPED) for m in p.finditer(text)]
        out += [(3, *m.span()) for m in CALLS.finditer(text)]
    if "::" in text or text.count(":") >= 7:
        out += [(1, *m.span()) for m in SIXES.finditer(text) if m.group().count(":") == 7 or m.group().count("::") == 1]
    return out


def _plain_address(text: str) -> str:
    """An address without its disguise."""
    text = re.sub(r"\x20?[(\[{]\x20?(?:at|@)\x20?[)\]}]\x20?", "@", text, flags=re.I)
    return re.sub(r"\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?", ".", text, flags=re.I)


def votes(kind: int, text: str, start: int, end: int, base: bool) -> list[int]:
    """One vote of each of ``LABELERS``."""
    span, before = text[start:end], text[max(0, start - 40):start].lower()
    number, plain = only_digits(span), _plain_address(span)
    sign = lambda yes, no=True: 1 if yes else -1 if no else 0
    if kind == 0:
        local, _, host = plain.rpartition("@")
        last = host.rpartition(".")[2].lower()
        validity = sign(len(last) >= 2 and last.isalpha())
        shape = sign(len(local) <= 64 and ".." not in local and local[0] not in ".-" and local[-1] not in ".-")
        known = sign(last in TOP_DOMAINS, not validity == 1)
    elif kind == 1:
        try:
            address = ipaddress.ip_address(plain)
        except ValueError:
            address = None
        validity = sign(address is not None)
        shape = sign(address is not None and (address.version == 4 or span.count(":") >= 3), address is None)
        known = sign(address is not None and not (address.is_unspecified or address.is_multicast or address.is_loopback))
    elif kind == 2:
        validity = sign(luhn(number))
        shape = sign(len(number) in (15, 16), len(number) not in (13, 14, 19))
        two, four = int(number[:2]), int(number[:4])
        known = sign(number[0] == "4" or 51 <= two <= 55 or 2221 <= four <= 2720 or two in (34, 37, 62, 65) or four == 6011 or 3528 <= four <= 3589)
    else:
        validity = sign(9 <= len(number) <= 15)
        shape = sign(any(c in span for c in "( -."), len(set(number)) <= 2)
        lead = number[2:] if number.startswith("00") else number
        coded = any(lead[:i] in COUNTRY_CODES for i in (1, 2, 3)) if span[0] == "+" or number.startswith("00") else number[0] in "023456789"
        known = sign(coded and len(set(number)) > 2)
    left, right = text[start - 1:start], text[end:end + 1]
    apart = (not left or left.isspace() or left in "(<[\"':;,|") and (not right or right.isspace() or right in ")>]\"':;,.!?|")
    return [sign(base, False), validity, shape, known, sign(any(c in before for c in CUES[KINDS[kind]]), False),
            -1 if any(c in before[-24:] for c in COUNTER_CUES) else 0, sign(apart)]


def _class(c: str) -> int:
    if not c:
        return 0
    if c == "\n":
        return 1
    if c.isspace():
        return 2
    if c.isdigit():
        return 3
    if c.isalpha():
        return 4
    return 5 if c in "([{<" else 6 if c in "\"'=:" else 7


# Numbers of features of a kind: shape, neighbours, word before, count of digits, votes on validity, cue and counter-cue.
SHAPES, CLASSES, WORDS, LENGTHS = 48, 8, 32, 6
WIDTH = SHAPES + 2 * CLASSES + WORDS + LENGTHS + 9
FEATURES = len(KINDS) * WIDTH


def features(kind: int, text: str, start: int, end: int, voted: list[int]) -> list[int]:
    """Places of a candidate's features, all of them 1."""
    span = text[start:min(end, start + 64)]
    shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in span)
    shape = re.sub("a+", "a", shape)
    word = text[max(0, start - 32):start].split()[-1:]
    digits = len(only_digits(span))
    out, at = [], kind * WIDTH
    for value, size in (
            (zlib.crc32(shape.encode()) % SHAPES, SHAPES), (_class(text[start - 1:start] if start else ""), CLASSES),
            (_class(text[end:end + 1]), CLASSES), (zlib.crc32(word[0].lower().encode()) % WORDS if word else 0, WORDS),
            (sum(digits >= x for x in (1, 9, 13, 16, 17)), LENGTHS),
            *((voted[LABELERS.index(n)] + 1, 3) for n in ("validity", "cue", "counter-cue"))):
        out.append(at + value)
        at += size
    return out


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """Base spans, and all candidates with votes and features, base spans among them."""
    base = base_spans(text)
    more, taken = [], sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
    last = dict.fromkeys(range(len(KINDS)), 0)
    for kind, start, end in sorted(set(proposals(text)), key=lambda x: (x[0], x[1], -x[2])):
        i = int(np.searchsorted(starts, end))  # base spans before i start before this one ends
        if start >= last[kind] and not (i and reach[i - 1] > start):
            more.append((kind, start, end))
            last[kind] = end
    out = []
    for own, spans in ((True, base), (False, more)):
        for kind, start, end in spans:
            voted = votes(kind, text, start, end, own)
            out.append({"kind": kind, "start": start, "end": end, "base": own, "votes": "".join("-0+"[v + 1] for v in voted),
                        "features": features(kind, text, start, end, voted)})
    return base, out


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string()),
                  ("features", pa.list_(pa.int32()))])


def searched(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the candidates of every document."""

    def search(batches):
        for batch in batches:
            text = batch.column(1)
            some = pc.fill_null(pc.match_substring_regex(text, r"[0-9@]|::|[(\[{] ?[aA@]"), False).to_pylist()
            found = [candidates(text[i].as_py())[1] if hit else [] for i, hit in enumerate(some)]
            yield pa.record_batch({"doc_id": batch.column(0), "found": pa.array(found, pa.list_(SPAN))})

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        search, "doc_id " + docs.schema["doc_id"].dataType.simpleString()
        + ", found array<struct<kind:int,start:int,end:int,base:boolean,votes:string,features:array<int>>>")


def reliabilities(patterns: list[tuple[str, bool, int]], rounds: int = ROUNDS) -> dict[tuple[str, bool], float]:
    """Posterior of each (votes, base) of one kind by expectation-maximisation over (votes, base, count).

    Labelers are independent given the class; base spans are right. Prior counts say that a labeler errs less often than
    not, which also settles which class is which.
    """
    ballots = np.array([["-0+".index(c) for c in v] for v, _, _ in patterns])
    base = np.array([b for _, b, _ in patterns])
    count = np.array([n for _, _, n in patterns], float)
    hot = np.eye(3)[ballots]  # pattern, labeler, vote
    prior = np.array([[4.0, 4.0, 1.0], [1.0, 4.0, 4.0]])
    agree = hot[:, 1:, 2].sum(1) - hot[:, 1:, 0].sum(1)
    right = np.where(base, 1.0, 1 / (1 + np.exp(-agree)))
    for _ in range(rounds):
        share = (1 + (count * right).sum()) / (2 + count.sum())
        log = np.log([1 - share, share])[:, None] + np.zeros((2, len(count)))
        for c, weight in ((0, 1 - right), (1, right)):
            votes_of = np.einsum("p,plv->lv", count * weight, hot) + prior[c]
            rate = np.log(votes_of / votes_of.sum(1, keepdims=True))
            # What a base pattern says is known already; it is no evidence on the other candidates.
            log[c] += np.einsum("plv,lv->p", hot[:, 1:], rate[1:])
        right = np.where(base, 1.0, 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50))))
    return {(v, b): float(p) for (v, b, _), p in zip(patterns, right)}


def posteriors(spark: SparkSession, spans: DataFrame) -> DataFrame:
    """(kind, votes, base, right): the probability of each vote pattern, from its counts over all documents."""
    counted = spans.groupBy("kind", "votes", "base").count().collect()
    rows = []
    for kind in range(len(KINDS)):
        own = sorted((r["votes"], r["base"], r["count"]) for r in counted if r["kind"] == kind)
        if own:
            rows += [(kind, v, b, p) for (v, b), p in reliabilities(own).items()]
    return spark.createDataFrame(rows, "kind int, votes string, base boolean, right double")


def classifier(spark: SparkSession, found: DataFrame) -> tuple[list[float], float]:
    """Weights of the features and intercept, learned from the posteriors of all candidates."""
    spans = found.select(F.explode("found").alias("x")).select("x.*")
    right = posteriors(spark, spans)
    each = spans.groupBy("kind", "votes", "base", "features").count().join(right, ["kind", "votes", "base"])
    both = F.explode(F.array(*(F.struct(F.lit(y).alias("label"), (F.col("count") * w).alias("weight"))
                               for y, w in ((1.0, F.col("right")), (0.0, 1 - F.col("right"))))))
    rows = each.select("features", both.alias("x")).groupBy("features", "x.label").agg(F.sum("x.weight").alias("weight"))
    rows = stored(rows.where("weight > 0"), "span-examples")
    sides = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    if min(sides.get(0.0, 0), sides.get(1.0, 0)) <= 0:
        return [0.0] * FEATURES, -math.inf  # nothing beyond base spans was proposed
    on = F.transform(F.sequence(F.lit(0), F.lit(FEATURES - 1)), lambda i: F.array_contains("features", i).cast("double"))
    rows = rows.withColumn("vector", array_to_vector(on))
    model = LogisticRegression(
        featuresCol="vector", labelCol="label", weightCol="weight", regParam=1e-4, maxIter=40, standardization=False).fit(rows)
    return model.coefficients.toArray().tolist(), float(model.intercept)


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans): base spans and accepted candidates as array<struct<kind, start, end, base>>, by kind and start."""
    spark = docs.sparkSession
    found = stored(searched(docs), "span-candidates")
    weights, intercept = classifier(spark, found)
    least = math.log(accept / (1 - accept)) - intercept
    score = lambda x: F.aggregate(x["features"], F.lit(0.0), lambda s, i: s + F.get(F.lit(weights), i))
    kept = F.filter("found", lambda x: x["base"] | (score(x) >= F.lit(least)))
    kept = F.transform(kept, lambda x: F.struct(*(x[n].alias(n) for n in ("kind", "start", "end", "base"))))
    return found.select("doc_id", F.array_sort(kept).alias("spans"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest of base spans, all spans as text."""
    found = find(docs)
    names = F.array(*map(F.lit, KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["base"])
    of_kind = lambda kind: F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: ~x["base"])).cast("long").alias("n_added"))
