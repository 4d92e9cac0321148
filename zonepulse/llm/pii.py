"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

Fixed patterns (email, ip, card, phone) always count.  Beyond them, wide
candidate patterns propose names, numbers and written-out addresses.  Regex,
checksum, gazetteer and context labelers vote +1 (private), -1 (harmless) or 0 (silent) on
each candidate.  Expectation-maximisation estimates the labelers' reliabilities
from the counts of vote patterns: at most 3**8 rows, whatever the corpus.  The
posteriors then train the span classifier, a naive Bayes model over hashed
features of the candidate's shape, size and context; its table has
``FEATURE_CELLS`` rows at most and is broadcast.  Candidates that score above
even odds and overlap no pattern span are added.

Texts are read once; candidates are few and are scored in a narrow table.

Edge cases: null text is empty; rows that repeat id and text share their spans;
null ids are kept; without candidates nothing is added; very long texts are
searched whole; only doc_id and text are read, so other columns can't clash; empty
tables work.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, row_key, scratch_table, text_of
from .spans import match_spans, overlaps

KINDS = ("email", "ip", "card", "phone")
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_VALID = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

#: Shapes of private numbers, each a candidate of its own: cards, social security, telephone, id numbers.
SHAPES = (r"(?:[0-9]{4}[\x20-]?){3}[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|"
          r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3,5}[\x20/-][0-9]{6,8}")
#: Words that stand before a name and are no part of it.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau".split()
LEADS = TITLES + ("Sir Madam Contact Dear Call Phone Tel Mobile Fax Email Mail Name Address From To Cc Attn Hi Hello Hallo "
                  "Regards Sincerely Thanks Signed").split()
_NO_LEAD = rf"(?!(?:{'|'.join(LEADS)})(?!\p{{L}}))"
_CAPITAL = r"(?:\p{Lu}\p{Ll}{1,20}+|\p{Lu}['’](?=\p{Lu}))(?:['’-]?\p{Lu}\p{Ll}{1,20}+)*+"

#: What may be personal beyond the fixed patterns.
CANDIDATES = (
    ("number", rf"(?<![0-9A-Za-z.,+])(?:(?:{SHAPES})(?![0-9A-Za-z]|[.-][0-9])|[0-9(][0-9\x20().-]{{4,30}}[0-9](?![0-9A-Za-z]))"),
    ("account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}+(?:\x20?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("address", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,40}+\x20?(?:"
                r"(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{2,40}+(?:\x20?(?:\.|\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,10})+|"
                r"at\x20[A-Za-z0-9-]{2,40}+\x20dot\x20[A-Za-z]{2,10})"),
    # two or more capitalised words, or one behind a title
    ("name", rf"(?<![\p{{L}}'’-]){_NO_LEAD}{_CAPITAL}(?:\x20(?:\p{{Lu}}\.\x20)?{_NO_LEAD}{_CAPITAL})++(?!\p{{L}})|"
             rf"(?<=(?<!\p{{L}})(?:{'|'.join(TITLES)})\.?\x20){_NO_LEAD}{_CAPITAL}(?!\p{{L}})"),
)
CONTEXT = 32
#: Gazetteers of given names and of capitalised words that name no person.
GIVEN = ("Aaron Adam Ahmed Aisha Alan Albert Alexander Ali Alice Amanda Amy Ana Andrea Andreas Andrew Angela Ann Anna Anne Antonio "
         "Arthur Barbara Benjamin Bernd Birgit Bob Brian Carlos Carmen Carol Catherine Charles Charlotte Chen Christian Christine Claire "
         "Claudia Daniel David Deborah Diana Diego Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Eva Fatima Francesca Francisco "
         "Frank Gary George Giulia Gonzalo Grace Hannah Hans Hassan Heike Helen Henry Hugo Ian Ibrahim Ines Ingrid Isabel Ivan Jack "
         "Jacob James Jan Jane Javier Jean Jennifer Jessica Joan John Jonas Jorge Jose Joseph Joshua Juan Julia Julie Karen Karl "
         "Katharina Kenneth Kevin Klaus Kwame Lars Laura Lena Leon Linda Lisa Louis Lucia Luis Lukas Manuel Marco Margaret Maria Marie "
         "Mario Mark Martha Martin Mary Matthew Michael Michel Miguel Miriam Mohammed Monika Nancy Natalia Nicolas Nicole Nina Olga Oliver "
         "Oscar Pablo Patricia Patrick Paul Pedro Peter Philip Philippe Pierre Priya Rachel Ralf Raj Ramon Rebecca Ricardo Richard Robert "
         "Rosa Ruth Ryan Sabine Samuel Sandra Sara Sarah Sergio Simon Sofia Sophie Stefan Stephen Steven Susan Susanne Teresa Thomas Timothy "
         "Tomas Ursula Victor Victoria Walter Wei William Wolfgang Yuki").split()
PLACES = ("January February March April May June July August September October November December Monday Tuesday "
          "Wednesday Thursday Friday Saturday Sunday North South East West New Old United States Public License "
          "Foundation Apache Creative Commons General University The This That").split()
#: Words before a span that speak for or against it.
BEFORE_PRIVATE = (r"(?i)(?:^|[^a-z])(?:phone|tel|telefon|mobile|fax|call|e-?mail|mail|contact|ssn|social security|iban|account|"
                  r"card|credit|passport|name|mr|mrs|ms|dr|herr|frau|born|address)[^0-9a-z]{1,4}$")
BEFORE_HARMLESS = (r"(?i)(?:(?:^|[^a-z])(?:page|pages|figure|fig|table|version|section|chapter|isbn|issn|no|vol|year|since|"
                   r"total|price|usd|eur)[^0-9a-z]{0,3}|[$€£#=/])$")
PRIVATE_SHAPES = rf"^(?:{SHAPES})$"
HARMLESS_SHAPES = r"^(?:(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)?[0-9]{2}|[0-9]{1,4}(?:[.\x20-][0-9]{1,4})?|(?:19|20)[0-9]{2}\x20?-\x20?(?:19|20)[0-9]{2})$"
FEATURE_CELLS = 4096
ROUNDS = 50


def _base(t: Column) -> list[Column]:
    digits = lambda m: F.regexp_replace(m, "[^0-9]", "")
    card = lambda x: F.length(digits(x["m"])).between(13, 19) & F.call_function("luhn_check", digits(x["m"]))
    return [
        match_spans(t, EMAIL, guard=F.contains(t, F.lit("@"))),
        F.filter(match_spans(t, IP), lambda x: F.rlike(x["m"], F.lit(IP_VALID))),
        F.filter(match_spans(t, CARD), card),
        F.filter(match_spans(t, PHONE, guard=F.contains(t, F.lit("+"))),
                 lambda x: F.length(digits(x["m"])).between(9, 15)),
    ]


def votes(kind: Column, m: Column, before: Column, given: list[str] = GIVEN) -> list[Column]:
    """One column of -1, 0 or 1 for each labeler; ``given`` is the gazetteer of names."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    words = F.split(m, r"\x20")
    one, no = F.lit(1), F.lit(-1)
    # numbers as long as a card's must pass its checksum
    long_number = F.length(digits).between(13, 19)
    sound = ~long_number | F.call_function("luhn_check", digits)
    known = lambda names: F.exists(words, lambda w: w.isin(names))
    return [
        F.when(F.rlike(m, F.lit(PRIVATE_SHAPES)) & sound | kind.isin("account", "address"), one).otherwise(0),  # regex
        F.when(F.rlike(m, F.lit(HARMLESS_SHAPES)), no).otherwise(0),                                         # regex
        F.when(kind == "number", F.when(~(F.length(digits).between(9, 19) & sound), no)                      # regex: digits,
               .when(F.rlike(before, F.lit(BEFORE_HARMLESS)), 0).otherwise(one)).otherwise(0),               # silent behind such a lead
        F.when((kind == "number") & ~sound, no).otherwise(0),                                                # checksum
        F.when(kind == "name", F.when(known(given), one).otherwise(0)).otherwise(0),                         # gazetteer
        F.when(kind == "name", F.when(known(PLACES), no).otherwise(0)).otherwise(0),                         # gazetteer
        F.when(F.rlike(before, F.lit(BEFORE_PRIVATE)), one).otherwise(0),                                    # context
        F.when(F.rlike(before, F.lit(BEFORE_HARMLESS)), no)
        .when((kind == "name") & ~F.rlike(before, F.lit(BEFORE_PRIVATE)), no).otherwise(0),                  # context
    ]


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[float]]:
    """Prior and each labeler's accuracy by expectation-maximisation over vote patterns and their counts."""
    size = len(patterns[0][0]) if patterns else 0
    prior, right = 0.5, [0.8] * size
    for _ in range(rounds):
        mass, agree, spoke = 0.0, [1.6] * size, [2.0] * size       # a prior of 0.8, two votes strong
        total = 0
        for v, n in patterns:
            p = posterior(v, prior, right)
            mass, total = mass + n * p, total + n
            for j, x in enumerate(v):
                if x:
                    spoke[j] += n
                    agree[j] += n * (p if x > 0 else 1 - p)
        prior = min(max((mass + 1) / (total + 2), 0.02), 0.98)
        right = [min(max(a / s, 0.55), 0.99) for a, s in zip(agree, spoke)]
    return prior, right


def posterior(v, prior: float, right: list[float]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(x * math.log(r / (1 - r)) for x, r in zip(v, right))
    return 1 / (1 + math.exp(-odds))


def _features(kind: Column, m: Column, before: Column) -> Column:
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]", "9"), "[A-Z]", "A"), "[a-z]+", "a")
    last = F.regexp_extract(F.lower(before), r"([a-z]+)[^a-z]*$", 1)
    cell = lambda tag, x: F.pmod(F.xxhash64(F.lit(tag), x), F.lit(FEATURE_CELLS)).cast("int")
    return F.array_distinct(F.array(
        cell("kind", kind), cell("shape", F.concat(kind, shape)), cell("mark", F.right(F.rtrim(before), F.lit(1))),
        cell("digits", F.length(F.regexp_replace(m, "[^0-9]", ""))), cell("word", last),
        cell("first", F.when(kind == "name", F.get(F.split(m, r"\x20"), 0))),
        cell("sum", F.call_function("luhn_check", F.regexp_replace(m, "[^0-9]", "")))))


def find_pii(docs: DataFrame, given: list[str] = GIVEN) -> DataFrame:
    """doc_id, the span array of each fixed kind, and ``added``: array of (kind, s, e) by kind and start."""
    t = pick(docs, "doc_id", "text").withColumn("t", text_of())
    t = t.select("doc_id", row_key().alias("key"), "t", *[c.alias(k) for k, c in zip(KINDS, _base(F.col("t")))])
    def candidates(kind: str, pattern: str) -> Column:
        return F.transform(match_spans(F.col("t"), pattern, CONTEXT), lambda x: F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["before"].alias("before")))
    found = [candidates(k, p) for k, p in CANDIDATES]
    t = t.select("doc_id", "key", *KINDS, F.concat(*found).alias("found"))
    rows = scratch_table(t, "pii_rows")

    spans = (rows.where(F.size("found") > 0).dropDuplicates(["key"])
             .select("key", F.concat(*KINDS).alias("base"), F.explode("found").alias("x"))
             .select("key", "x.*", overlaps(F.col("x"), F.col("base")).alias("known")))
    v = votes(F.col("kind"), F.col("m"), F.col("before"), given)
    # a span that a fixed pattern has accepted is one more +1 of the regex labeler
    v[0] = F.when(F.col("known"), 1).otherwise(v[0])
    spans = scratch_table(spans.select("key", "kind", "s", "e", "known", F.array(*v).alias("votes"),
                                       _features(F.col("kind"), F.col("m"), F.col("before")).alias("cells")), "pii_spans")
    counted = spans.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()     # 3**8 patterns at most
    patterns = sorted((tuple(r["votes"]), r["n"]) for r in counted)
    prior, right = reliabilities(patterns)
    odds = reduce(lambda a, b: a + b, [F.get("votes", F.lit(j)) * math.log(r / (1 - r)) for j, r in enumerate(right)],
                  F.lit(math.log(prior / (1 - prior))))
    soft = spans.withColumn("p", 1 / (1 + F.exp(-odds)))
    cells = (soft.select("p", F.explode("cells").alias("cell")).groupBy("cell")
             .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")))
    total = soft.agg(F.sum("p"), F.sum(1 - F.col("p"))).first()
    yes, no = total[0] or 0.0, total[1] or 0.0
    start = math.log((yes + 1) / (no + 1))
    rate = (yes + 1) / (yes + no + 2)                 # a cell starts from one span at the overall rate
    weights = cells.select("cell", (F.log((F.col("yes") + rate) / (F.col("no") + (1 - rate))) - start).alias("w"))
    scored = (soft.where(~F.col("known")).select("key", "kind", "s", "e", F.explode("cells").alias("cell"))
              .join(F.broadcast(weights), "cell")                                   # FEATURE_CELLS rows at most
              .groupBy("key", "kind", "s", "e").agg((F.sum("w") + start).alias("score")))
    order = F.array_position(F.array(*[F.lit(k) for k, _ in CANDIDATES]), F.col("kind"))
    added = (scored.where("score > 0").groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "s", "e", "kind"))).alias("added")))
    added = scratch_table(added, "pii_added")
    none = F.array().cast("array<struct<o:bigint,s:int,e:int,kind:string>>")
    return (rows.drop("found").join(added, "key", "left")
            .select("doc_id", *KINDS, F.coalesce("added", none).alias("added")))
