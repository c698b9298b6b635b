"""Personal data in whole texts: labelers vote on candidates, expectation-maximisation weighs them, a classifier decides.

DataFrame functions only. Fixed values: the patterns, number ranges and order of the four kinds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Scratch

KINDS = ["email", "ip", "card", "phone"]

# The patterns of the base rules, written so that no text makes them slow: runs are possessive, and a run of
# characters that can start a match is tried once, at its head or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates, which only the classifier can admit: e-mail addresses that are spelt out, eight-group addresses, numbers
# without country code. Card-like numbers that fail the checksum are candidates too.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# A gazetteer and cue words by kind; own lists.
GAZETTEER = {
    "email": r"(?i)(?:\.|\(dot\)|\[dot\])\x20?(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?!0+\.|127\.|255\.|22[4-9]\.|23[0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|9)",
    "phone": r"^(?:\+(?:1|33|34|39|4[0-9]|5[0-9]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])",
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|schreib|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|address|host|server|login)",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|account)",
    "phone": r"(?i)(?:tel|phone|call|mobil|fax|anruf|llam)",
}
COUNTER_CUES = r"(?i)(?:version|isbn|issn|order|ref\.?|release|section|chapter|article|§|#|=)\W{0,3}$"
LABELERS = ["rule", "checks", "gazetteer", "context", "edges"]
CONTEXT = 24
#: Outputs gathered at a time, and code points of a piece of a text. Neither changes a result.
CHUNK, PIECE = 32, 512
#: Candidates outside the base rules are admitted from this probability on.
ADMIT = 0.9


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (F.lit(1) + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    """What a match of the base pattern must also hold."""
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(found)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("o")


_SPAN = "array<struct<start:int,kind:int,end:int,base:boolean,votes:string,shape:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _scan(items: Column, first: Column, step, out: str) -> Column:
    """Array of outputs along ``items``; ``step(state, x)`` gives an output of type ``out`` and the next state.

    Every step of a fold copies what it has gathered, and a text may hold very many matches. So a first fold finds only the states
    before each chunk, and the outputs are gathered chunk by chunk from there.
    """

    def behind(states: Column, chunk: Column) -> Column:
        return F.concat(states, F.array(F.aggregate(chunk, F.element_at(states, -1), lambda state, x: step(state, x)[1])))

    def one(acc: Column, x: Column) -> Column:
        made, state = step(acc["state"], x)
        return F.struct(F.concat(acc["out"], F.array(made)).alias("out"), state.alias("state"))

    def outputs(chunk: Column, state: Column) -> Column:
        return F.aggregate(chunk, F.struct(F.array().cast(f"array<{out}>").alias("out"), state.alias("state")), one)["out"]

    def gathered(chunks: Column) -> Column:
        states = F.aggregate(chunks, F.array(first), behind)
        return _let(states, lambda s: F.flatten(F.transform(chunks, lambda chunk, i: outputs(chunk, F.get(s, i)))))

    numbers = lambda all_: F.sequence(F.lit(0), F.ceil(F.size(all_) / CHUNK).cast("int") - 1)
    return _let(_let(items, lambda all_: F.transform(numbers(all_), lambda c: F.slice(all_, c * CHUNK + 1, CHUNK))), gathered)


def _blocks(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, so that a place is found without a walk from the start."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in blocks; what lies beyond its end is empty."""
    i, j = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    block = lambda n: F.coalesce(F.get(blocks, n), F.lit(""))
    head, tail = F.substring(block(i), start % PIECE + 1, F.lit(PIECE)), F.substring(block(j), F.lit(1), end % PIECE)
    inner = F.when(j - i > 1, F.array_join(F.slice(blocks, i + 2, j - i - 1), "")).otherwise("")
    return F.when(i == j, F.substring(block(i), start % PIECE + 1, end - start)).otherwise(F.concat(head, inner, tail))


def _matches(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Candidates of one pattern: positions in code points, whether a base rule holds, the labelers' votes and the shape."""
    number = KINDS.index(kind)

    def place(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit")), end

    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One gap more than hits: the text behind the last.
    zipped = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull())
    placed = _scan(zipped, F.lit(0), place, "struct<start:int,end:int,hit:string>")

    def judged(blocks: Column, m: Column) -> Column:
        read = F.struct(
            _between(blocks, F.greatest(m["start"] - CONTEXT, F.lit(0)), m["start"]).alias("before"),
            _between(blocks, m["end"], m["end"] + 1).alias("after"), _digits(m["hit"]).alias("digits"),
            F.regexp_replace(m["hit"], "[^0-9A-Fa-f@.+]", "").alias("compact"), (_valid(kind, m["hit"]) if base else F.lit(False)).alias("holds"),
        )
        return _let(read, lambda r: _let(answers(m, r), lambda a: span(m, r, a)))

    def answers(m: Column, r: Column) -> Column:
        size = F.length(r["digits"])
        checks = _luhn(r["digits"]) if kind == "card" else size.between(10, 15) if kind == "phone" else F.length(m["hit"]) <= 254
        return F.struct(
            checks.alias("checks"), r["compact"].rlike(GAZETTEER[kind]).alias("listed"), F.lower(r["before"]).rlike(CUES[kind]).alias("cued"),
            r["before"].rlike(COUNTER_CUES).alias("countered"), (r["before"].rlike(r"[\p{L}\p{N}]$") | r["after"].rlike(r"^[\p{L}\p{N}]")).alias("tight"),
        )

    def span(m: Column, r: Column, a: Column) -> Column:
        hit = m["hit"]
        votes = F.concat(
            _vote(r["holds"], F.lit(not base)), _vote(a["checks"], ~a["checks"]), _vote(a["listed"], F.lit(True)),
            _vote(a["cued"] & ~a["countered"], a["countered"]), _vote(~a["tight"], a["tight"]),
        )
        shape = F.concat(
            F.when(hit.rlike(r"\("), "p").when(hit.rlike("-"), "d").when(hit.rlike(r"\x20"), "s").otherwise("n"),
            F.least(F.length(r["digits"]), F.lit(20)).cast("string"),
        )
        return F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), r["holds"].alias("base"), votes.alias("votes"), shape.alias("shape")
        )

    found = _let(_blocks(text), lambda blocks: F.transform(placed, lambda m: judged(blocks, m)))
    if base and kind == "card":  # near misses of the right size stay candidates
        sized = F.filter(found, lambda c: c["base"] | F.substring(c["shape"], 2, 2).cast("int").between(13, 19))
    elif base:
        sized = F.filter(found, lambda c: c["base"])
    else:
        sized = found
    probe = text.contains("@") & text.rlike(pattern) if (kind, base) == ("email", True) else text.rlike(pattern)
    return F.when(probe, sized.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def candidates(text: Column) -> Column:
    """All candidates of a text, by start and kind; a null text has none. What overlaps a base span is left out."""
    base = F.concat(*[_matches(text, k, BASE[k], True) for k in KINDS])
    wider = F.concat(*[_matches(text, k, p, False) for k, p in WIDER.items()])

    return F.coalesce(_let(F.array_sort(F.concat(base, wider)), _apart), F.array().cast(_SPAN))


def _apart(ordered: Column) -> Column:
    """Candidates by start without the wider ones that overlap a base span: one sweep each way instead of all pairs."""
    item = f"struct<span:{_SPAN[6:-1]},lost:boolean>"
    first = F.transform(ordered, lambda c: F.struct(c.alias("span"), F.lit(False).alias("lost")))

    def sweep(items: Column, far: int, meets, reach) -> Column:
        def step(state: Column, x: Column) -> tuple[Column, Column]:
            base = x["span"]["base"]
            lost = x["lost"] | (~base & meets(state, x["span"]))
            return F.struct(x["span"].alias("span"), lost.alias("lost")), F.when(base, reach(state, x["span"])).otherwise(state)

        return _scan(items, F.lit(far), step, item)

    ahead = sweep(first, 0, lambda end, c: c["start"] < end, lambda end, c: F.greatest(end, c["end"]))
    back = sweep(F.reverse(ahead), (1 << 31) - 1, lambda start, c: start < c["end"], lambda start, c: c["start"])
    swept = F.transform(F.filter(F.reverse(back), lambda x: ~x["lost"]), lambda x: x["span"])
    mixed = F.exists(ordered, lambda c: c["base"]) & F.exists(ordered, lambda c: ~c["base"])
    return F.when(mixed, swept).otherwise(ordered)


def reliabilities(counts: list[tuple[str, int]], rounds: int = 100) -> tuple[float, list[tuple[float, float]]]:
    """(share of true candidates, per labeler the chance of a yes on true and on false ones), from counts of vote patterns.

    Expectation-maximisation of two classes with independent labelers; a labeler that abstains says nothing.
    """
    prior, rates = 0.5, [(0.8, 0.2)] * len(LABELERS)
    for _ in range(rounds):
        weights = [(votes, n, _posterior(votes, prior, rates)) for votes, n in counts]
        total = sum(n for _, n, _ in weights)
        prior = (sum(n * p for _, n, p in weights) + 1) / (total + 2)
        new = []
        for j in range(len(LABELERS)):
            yes = [(n, p) for v, n, p in weights if v[j] == "+"]
            said = [(n, p) for v, n, p in weights if v[j] != "o"]
            true = (sum(n * p for n, p in yes) + 4) / (sum(n * p for n, p in said) + 5)
            false = (sum(n * (1 - p) for n, p in yes) + 1) / (sum(n * (1 - p) for n, p in said) + 5)
            new.append((true, min(false, true)))
        rates = new
    return prior, rates


def _posterior(votes: str, prior: float, rates: list[tuple[float, float]]) -> float:
    odds = math.log(prior / (1 - prior))
    for v, (true, false) in zip(votes, rates, strict=True):
        odds += math.log(true / false) if v == "+" else math.log((1 - true) / (1 - false)) if v == "-" else 0.0
    return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def fit(found: DataFrame) -> dict[str, float]:
    """The span classifier: log-odds by ``kind:votes`` and ``kind:shape``, and by ``kind:`` for what was never seen.

    ``found`` has the candidates of all documents. Both the counts that expectation-maximisation reads and the features' soft counts are
    bounded tables: 4 kinds, 3**5 vote patterns, 84 shapes.
    """
    span = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.shape")
    counted = [tuple(r) for r in span.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")).collect()]
    weights: dict[str, float] = {}
    for kind in range(len(KINDS)):
        own = [(votes, shape, n) for k, votes, shape, n in counted if k == kind]
        if not own:
            continue
        prior, rates = reliabilities([(votes, n) for votes, _, n in own])
        true, false = {}, {}
        for votes, shape, n in own:
            p = _posterior(votes, prior, rates)
            weights[f"{kind}:{votes}"] = math.log(max(p, 1e-9) / max(1 - p, 1e-9))
            true[shape] = true.get(shape, 0) + n * p
            false[shape] = false.get(shape, 0) + n * (1 - p)
        all_true, all_false = sum(true.values()), sum(false.values())
        for shape in true:
            weights[f"{kind}:{shape}"] = math.log((true[shape] + 1) / (all_true + len(true))) - math.log((false[shape] + 1) / (all_false + len(true)))
    return weights


def admitted(found: Column, weights: dict[str, float]) -> Column:
    """The spans that stand: base ones, and candidates whose probability reaches ``ADMIT``."""
    table = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), F.lit(w))]) if weights else F.lit(None).cast("map<string,double>")
    limit = math.log(ADMIT / (1 - ADMIT))

    def stands(c: Column) -> Column:
        of = lambda part: F.coalesce(F.try_element_at(table, F.concat(c["kind"].cast("string"), F.lit(":"), c[part])), F.lit(0.0))
        return c["base"] | (of("votes") + of("shape") >= limit)

    return F.filter(found, stands)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", names[c["kind"]], c["start"].cast("string"), c["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and kind, comma-joined. The counts and ``base_spans`` are of the base rules; ``spans``
    adds what the classifier admits. A null or empty text has none; rows with null or repeated ids are judged each by itself.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(docs.select(F.col("doc_id").cast("bigint"), candidates(F.col("text")).alias("candidates")), "candidates")
    spans, base = admitted(F.col("candidates"), fit(found)), F.filter("candidates", lambda c: c["base"])
    of_kind = lambda i: F.filter("candidates", lambda c: c["base"] & (c["kind"] == i))
    counts = [F.size(of_kind(i)).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, _listed(base).alias("base_spans"), _listed(spans).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, every span that stands replaced in ``text`` by its kind in angle brackets; spans that overlap become one."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(docs.withColumn("__candidates", candidates(F.col("text"))), "candidates")
    weights = fit(found.select(F.col("__candidates").alias("candidates")))
    spans, text = admitted(F.col("__candidates"), weights), F.col("text")
    names = F.array(*map(F.lit, KINDS))

    def masked(t: Column) -> Column:
        def step(at: Column, c: Column) -> tuple[Column, Column]:
            piece = F.concat(_between(t["blocks"], at, c["start"]), F.lit("<"), names[c["kind"]], F.lit(">"))
            return F.when(c["start"] >= at, piece).otherwise(""), F.greatest(at, c["end"])

        behind = F.array_max(F.transform(t["spans"], lambda c: c["end"]))
        return F.concat(F.array_join(_scan(t["spans"], F.lit(0), step, "string"), ""), _between(t["blocks"], behind, t["size"]))

    whole = F.struct(spans.alias("spans"), _blocks(text).alias("blocks"), F.length(text).alias("size"))
    new = F.when(F.size("__candidates") > 0, _let(whole, lambda t: F.when(F.size(t["spans"]) > 0, masked(t)).otherwise(text))).otherwise(text)
    return found.select(*[new.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
