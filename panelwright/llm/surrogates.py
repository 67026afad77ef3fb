"""PII: detected entities give way to keyed surrogates of their own kind. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.joins import join_aggregate
from panelwright.session import numbered, sized, stored

# What the patterns look for.
ASCII_SIGNS = "!#$%*+-.:;=?@^_~"
SECRET_NAMES = "password|passwd|pwd|secret|token|api_key|apikey|api-key|access_key"
MALE_TITLES, FEMALE_TITLES = r"Mr\.?|Herr|Monsieur|Señor|Sr\.", r"Mrs\.?|Ms\.?|Miss|Frau|Mme\.?|Madame|Señora|Sra\."
MALE_TITLES_CYRILLIC, FEMALE_TITLES_CYRILLIC = "господин|г-н", "госпожа|г-жа"

_TITLES = f"(?:{MALE_TITLES}|{FEMALE_TITLES}|{MALE_TITLES_CYRILLIC}|{FEMALE_TITLES_CYRILLIC})"
# What may stand before a word of a name; no title starts a word of the name before it.
_PARTICLES = r"(?:(?:von|van|der|den|de|del|della|di|da|dos|du|la|le|zu|zur|zum|und|y|bin|ibn|al|el|Dr\.?|Prof\.?) ){0,4}+"
_WORD = rf"{_PARTICLES}(?!{_TITLES} )(?:\p{{Lu}}\. )*+\p{{Lu}}[\p{{L}}\p{{M}}'’-]++"

# One alternative per kind, in order of preference; none can match nothing, none backtracks over a long run.
PATTERNS = {
    "secret": rf"(?<![A-Za-z0-9_])(?i:{SECRET_NAMES})[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?[^\s\"']{{6,}}",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+\(?[0-9]\)?(?:[ .-]?\(?[0-9]\)?){6,14}(?![0-9])|\(?[0-9]{2}\)?(?:[ .-][0-9]{2}){3,6}(?![0-9])"
             r"|(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9]))",
    "name": rf"(?<!\p{{L}}){_TITLES} {_WORD}(?: {_WORD})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Every kind needs one of these signs, the prefix of a key, or one of these words of a title; most texts have none and are not searched.
SIGNS = "[0-9@=:]"
KEY_PREFIX = "AKIA"
TITLE_PARTS = "Mr Ms Miss Herr Monsieur Señor Sr. Sra. Frau Mme Madame господин госпожа г-н г-жа".split()

# Draws of a value of fixed format before it is made longer.
OFTEN = 16

# Names that stand in, by gender and script.
GIVEN = {
    "male latin": "Adam Alan Anton Ben Carl David Eric Felix Frank George Henry Hugo Ivan Jack Jonas Karl Leo Lucas Mark Martin Max Noah Oscar Paul Peter Ralph Simon Theo Thomas Victor Walter Xavier",
    "female latin": "Ada Alice Anna Bella Clara Diana Elena Emma Eva Flora Gina Hanna Helen Ida Irene Julia Karin Laura Lena Lisa Maria Martha Mia Nora Olga Paula Rosa Sara Sofia Tina Vera Zoe",
    "male cyrillic": "Андрей Антон Борис Вадим Виктор Глеб Денис Егор Иван Игорь Кирилл Максим Олег Павел Роман Юрий",
    "female cyrillic": "Алина Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лариса Мария Нина Ольга Полина Раиса Юлия",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke la le lo ma me mo na ne no pa ra re ro sa se ta te va",
    "cyrillic": "ба бе во га да ди за ка ке ла ли ма ми на не по ра ре ри са се та ти ха",
}


def _each(array: Column, **fields) -> Column:
    """Structs with further fields, each a function of the struct; every value is worked out once."""
    def grown(x: Column) -> Column:
        return x.withField(next(iter(fields)), next(iter(fields.values()))(x))

    out = F.transform(array, grown)
    rest = dict(list(fields.items())[1:])
    return _each(out, **rest) if rest else out


def _kind(x: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(PATTERNS.items())[:-1]):
        out = F.when(x["e"].rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _plain(e: Column) -> Column:
    return F.regexp_replace(e, r"[^0-9A-Za-z]", "")


def _lead(x: Column) -> Column:
    """What of a mention stays: the name of a secret, a key's or country's prefix, a title."""
    secret = rf"^(?i:{SECRET_NAMES})[ \t]*[=:][ \t]*[\"']?"
    return (
        F.when(x["k"] == "secret", F.regexp_extract(x["e"], secret, 0)).when(x["k"] == "key", F.lit("AKIA"))
        .when(x["k"] == "iban", F.substring(x["e"], 1, 2)).when(x["k"] == "phone", F.regexp_extract(x["e"], r"^\+[0-9]{1,3}(?=[ .-])", 0))
        .when(x["k"] == "name", F.regexp_extract(x["e"], r"^[^ ]+ ", 0)).otherwise("")
    )


def _group(x: Column) -> Column:
    """Gender and script of a name, by its title and letters; empty for other kinds."""
    female = x["lead"].rlike(rf"^(?:{FEMALE_TITLES}|{FEMALE_TITLES_CYRILLIC}) $")
    script = F.when(x["rest"].rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    return F.when(x["k"] == "name", F.concat(F.when(female, "female ").otherwise("male "), script)).otherwise("")


def _canon(x: Column) -> Column:
    """What mentions of one entity have in common: its digits, its lower-case address, its name."""
    return (
        F.when(x["k"].isin("card", "iban", "ssn"), _plain(x["e"]))
        .when(x["k"] == "phone", F.concat(x["lead"], F.lit(":"), F.regexp_replace(x["rest"], "[^0-9]", "")))
        .when(x["k"] == "email", F.lower(x["e"])).when(x["k"] == "name", F.concat(x["group"], F.lit(" "), x["rest"]))
        .when(x["k"] == "secret", x["rest"]).otherwise(x["e"])
    )


def described(found: Column, kind: Column | None = None) -> Column:
    """Structs (e, k, lead, rest, group, canon) of an array of mentions."""
    start = F.transform(found, lambda e: F.struct(e.alias("e")))
    return _each(
        start, k=_kind if kind is None else lambda x: kind, lead=_lead,
        rest=lambda x: F.substring(x["e"], F.length(x["lead"]) + 1, F.length(x["e"])), group=_group, canon=_canon,
    )


def _stream(key: str):
    """128 keyed hex digits of an entity: two rounds of SHA-256 under the key."""
    def of(x: Column) -> Column:
        inner = F.sha2(F.concat_ws("\u001f", F.lit(key), x["k"], x["canon"], x["attempt"].cast("string")), 256)
        return F.concat(F.sha2(F.concat(F.lit(key), inner, F.lit("0")), 256), F.sha2(F.concat(F.lit(key), inner, F.lit("1")), 256))

    return of


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(words: str, number: Column) -> Column:
    listed = F.array(*[F.lit(w) for w in words.split()])
    return F.get(listed, F.pmod(number, F.lit(len(words.split()))))


def _luhn(digits: Column) -> Column:
    """The check digit behind the given digits."""
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1))
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return ((10 - total % 10) % 10).cast("string")


def _masked(rest: Column, stream: Column, shift: int = 0, whole: bool = False) -> Column:
    """Letters give way to letters of their case, digits to digits; all other signs stay.

    ``whole``: nothing stays. ASCII signs give way to such signs, letters of other scripts to a-z.
    """
    drawn = F.transform(F.split(rest, ""), lambda c, i: F.struct(c.alias("c"), _byte(stream, i + shift).alias("b")))

    def one(x: Column) -> Column:
        c, b = x["c"], x["b"]
        return (
            F.when(c.rlike("^[0-9]$"), (b % 10).cast("string"))
            .when(c.rlike("^[a-f]$"), F.substring(F.lit("abcdef"), b % 6 + 1, F.lit(1)))
            .when(c.rlike("^[g-z]$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), b % 26 + 1, F.lit(1)))
            .when(c.rlike("^[A-Z]$"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), b % 26 + 1, F.lit(1)))
            .otherwise(other(c, b))
        )

    def other(c: Column, b: Column) -> Column:
        if not whole:
            return c
        return F.when(c.rlike("^[!-~]$"), F.substring(F.lit(ASCII_SIGNS), b % len(ASCII_SIGNS) + 1, F.lit(1))).otherwise(
            F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), b % 26 + 1, F.lit(1)))

    return F.array_join(F.transform(drawn, one), "")


def _wider(x: Column, after: int, digits: bool) -> Column:
    """Further signs for an entity that lost more than ``after`` draws, one more each time: its format may have too few values."""
    drawn = F.transform(F.sequence(F.lit(1), F.greatest(x["attempt"] - after, F.lit(1))), lambda i: (_byte(x["stream"], i + 40) % 10).cast("string") if digits
                        else F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _byte(x["stream"], i + 40) % 26 + 1, F.lit(1)))
    return F.when(x["attempt"] > after, F.array_join(drawn, "")).otherwise("")


def _laid_out(mention: Column, signs: Column) -> Column:
    """Signs put in the places of a mention's digits and letters, its separators as they were."""
    at = lambda i: F.length(_plain(F.substring(mention, F.lit(1), i)))
    return F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
        c.rlike("^[0-9A-Za-z]$"), F.substring(signs, at(i) + 1, F.lit(1))).otherwise(c)), "")


def _mask(x: Column) -> Column:
    """Masked signs: of the user part of an address, the value of a secret, else of the letters and digits alone."""
    return (
        F.when(x["k"] == "email", _masked(F.lower(F.regexp_extract(x["e"], "^([^@]+)@", 1)), x["stream"]))
        .when(x["k"] == "secret", _masked(x["rest"], x["stream"], whole=True))
        .when(x["k"].isin("ip", "name"), "").otherwise(_masked(_plain(x["rest"]), x["stream"]))
    )


def _family(x: Column, shift: int | Column) -> Column:
    latin = F.concat(*[_pick(SYLLABLES["latin"], _byte(x["stream"], F.lit(shift) + k)) for k in range(4)])
    cyrillic = F.concat(*[_pick(SYLLABLES["cyrillic"], _byte(x["stream"], F.lit(shift) + k)) for k in range(4)])
    return F.initcap(F.when(x["group"].endswith("latin"), latin).otherwise(cyrillic))


def _made(x: Column) -> Column:
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(x["stream"], i) % 254 + 1).cast("string")), ".")
    domain, top = (F.lower(F.regexp_extract(x["e"], r"^[^@]+@(.*)(\.[^.]+)$", k)) for k in (1, 2))
    given = F.lit("")
    for name, words in GIVEN.items():
        given = F.when(x["group"] == name, _pick(words, _byte(x["stream"], F.lit(0)))).otherwise(given)
    # One name gives way to a family name, more to a given one and family names; a second one widens the room after collisions.
    family = F.when(x["attempt"] > 1, F.concat(_family(x, 1), F.lit("-"), _family(x, 5))).otherwise(_family(x, 1))
    more = F.size(F.split(x["rest"], " ")) - 2
    further = F.when(more > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), lambda i: F.concat(F.lit(" "), _family(x, i * 4 + 5))), "")).otherwise("")
    name = F.when(more >= 0, F.concat(given, F.lit(" "), family, further)).otherwise(family)
    body = F.substring(x["mask"], F.lit(1), F.length(x["mask"]) - 1)
    # Free in length: more letters from the third draw on. Fixed: more digits, once OFTEN draws were taken.
    letters, digits = _wider(x, 1, False), _wider(x, OFTEN, True)
    return (
        F.when(x["k"] == "email", F.concat(x["mask"], letters, F.lit("@"), _masked(domain, x["stream"], 31), top))
        .when(x["k"] == "ip", F.concat(octets, digits)).when(x["k"] == "name", F.concat(x["lead"], name))
        .when(x["k"] == "card", F.concat(_laid_out(x["e"], F.concat(body, _luhn(body))), digits))
        .when(x["k"] == "secret", F.concat(x["lead"], x["mask"], letters))
        .otherwise(F.concat(x["lead"], _laid_out(x["rest"], x["mask"]), digits))
    )


def surrogates(entities: Column, attempt, key: str) -> Column:
    """The replacements of an array of described mentions: of their kind and format, one for all mentions of an entity."""
    full = _each(entities, attempt=attempt, stream=_stream(key), mask=_mask)
    return F.transform(full, _made)


def mentions(text: str) -> Column:
    """All mentions of a text in order; an empty array for a null text."""
    value = F.coalesce(F.col(text), F.lit(""))
    possible = value.rlike(SIGNS)
    for part in [KEY_PREFIX, *TITLE_PARTS]:
        possible = possible | F.contains(value, F.lit(part))
    return F.when(possible, F.regexp_extract_all(value, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def settled(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogate is taken: each gets the next free one.

    ``entities`` has (kind, canon, mention) with one mention per entity. A surrogate is taken if another
    entity has it already or if it is itself an entity of the corpus. Repeats until all are distinct, which ends as
    later draws have ever more values: see ``_wider``; names get a second family name.
    """
    now = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    while True:
        one = surrogates(described(F.array("mention"), F.col("kind")), lambda x: F.col("attempt"), key)
        made = now.withColumn("_s", F.get(described(one, F.col("kind")), F.lit(0))).withColumn("made", F.col("_s.canon")).drop("_s")
        claims = made.select("kind", "made", F.struct("attempt", "canon").alias("who")).unionByName(
            # Real entities come before all surrogates.
            now.select("kind", F.col("canon").alias("made"), F.struct(F.lit(-1).alias("attempt"), "canon").alias("who")))
        taken = claims.groupBy("kind", "made").agg(F.min("who").alias("first"), F.count("*").alias("n")).filter("n > 1")
        lost = made.join(taken, ["kind", "made"]).filter(F.struct("attempt", "canon") != F.col("first")).select("kind", "canon")
        lost = stored(lost, "collisions")
        if lost.isEmpty():
            return now.filter("attempt > 0").select("kind", "canon", "attempt")
        again = lost.withColumn("_again", F.lit(1))
        now = stored(now.join(again, ["kind", "canon"], "left").withColumn(
            "attempt", F.col("attempt") + F.coalesce("_again", F.lit(0))).drop("_again"), "entities")


def replace(docs: DataFrame, key: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``docs`` with surrogates in the text and the number of replaced mentions in ``count``; other columns stay.

    Mentions of one entity get one surrogate in all documents, different entities different ones. Null
    texts stay null; documents without a mention stay as they are. A column named ``count`` is replaced. Texts are
    not shuffled, unless more than a broadcast's worth of documents hold entities whose surrogate collided.
    """
    docs = docs.drop(count)
    placed = numbered(docs, "numbered").withColumn("_text", F.col("_row")[text])
    found = placed.select("_place", F.explode(described(mentions("_text"))).alias("_m"))
    found = found.select("_place", F.col("_m.e").alias("_e"), F.col("_m.k").alias("_kind"), F.col("_m.canon").alias("_canon"))
    found = stored(found, "mentions")
    entities = found.groupBy(F.col("_kind").alias("kind"), F.col("_canon").alias("canon")).agg(
        F.min("_e").alias("mention"), F.count("*").alias("_rows"))
    moved = stored(settled(entities.drop("_rows"), key), "moved")
    attempt = lambda x: F.lit(0)
    if not moved.isEmpty():
        counted = entities.drop("mention").join(moved, ["kind", "canon"]).withColumnsRenamed({"kind": "_kind", "canon": "_canon"})
        hit = join_aggregate(found, counted, ["_kind", "_canon"], "_rows", "inner", "moved-counts")
        per_doc = hit.groupBy("_place").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\u001f", "_kind", "_canon"), F.col("attempt")))).alias("_moved"))
        placed = placed.join(sized(per_doc, "moved-documents"), "_place", "left")
        attempt = lambda x: F.coalesce(F.try_element_at("_moved", F.concat_ws("\u001f", x["k"], x["canon"])), F.lit(0))
    held = placed.withColumn("_found", mentions("_text"))
    made = surrogates(described(F.col("_found")), attempt, key)
    between = F.split(F.col("_text"), ANY, -1)
    joined = F.array_join(F.zip_with(between, F.concat(made, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    new = F.when(F.size("_found") > 0, joined).otherwise(F.col("_text"))
    return held.select(F.col("_row").withField(text, new).alias("_row"), F.size("_found").cast("long").alias(count)).select("_row.*", count)
