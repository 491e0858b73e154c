"""Personal data replaced by surrogates: keyed, of the same type, and consistent.

Detected are e-mail addresses, IPv4 addresses, card numbers, social security numbers, phone numbers, and
names after a title. A mention is reduced to its entity: an address in lower case, a number's digits, a
name's words; the same entity has the same surrogate in every document and every format. A surrogate is
made from a keyed hash: letters become letters of their script and case, digits digits; card numbers stay
valid or invalid, names keep the title's gender and their script, hosts end in the reserved `.example`.

No two entities of a kind share a surrogate and none gets what another entity really is: colliding ones
are made again with the next number, round by round, until none collides. Where many entities have one shape
there may be more of them than surrogates of it, so after every `LENGTHENED` rounds those that still collide grow
by a letter or digit; addresses of hosts and card numbers, of which there are enough, keep their length. The rounds
are joins on tables in the shared folder. All of it is DataFrame functions; only rows with mentions are joined to surrogates.

Known limits: a name is its words, so that `Mr. John Smith` and `Mr. Smith` are two entities, and a name without a
title is not found.

Defined cases: a null text stays null; repeated rows are rewritten alike; without mentions a text is
returned as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.arrow import kept_columns
from eventmart.sources.staging import stage

# How each kind is written. Possessive runs keep a search linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"
CARD = r"(?<![\w+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ -]\d{4})(?!\w)"
_HE = r"Mr|Herr|Herrn|Monsieur|Señor|Sr|Signor|господин|κύριος"
_SHE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Signora|госпожа|κυρία"
# One to three words, each with inner capitals, apostrophes and hyphens.
_WORD = r"\p{Lu}\p{L}*+(?:['’-]\p{L}++)*+"
NAME = rf"(?<!\w)(?:{_HE}|{_SHE})\.? {_WORD}(?: {_WORD}){{0,2}}"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "ssn": SSN, "phone": PHONE, "name": NAME}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

# Splits a value into its characters.
_EACH = "(?!^)(?!$)"

# Letters by script, and given names by script and gender, sixteen each.
_HEX = "0123456789abcdef"
_LATIN = "abcdefghiklmnoprst"[:16]
_CYRILLIC = "абвгдезиклмнопрс"
_GREEK = "αβγδεζηικλμνοπρτ"
NAMES = {
    ("latin", "m"): "Adam Ben Carl David Erik Felix Georg Henry Ivan Jonas Karl Leon Max Noah Oscar Paul",
    ("latin", "f"): "Anna Berta Clara Diana Emma Frieda Greta Helen Ida Julia Klara Laura Maria Nora Olga Paula",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Семён",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Ева Жанна Зоя Инна Карина Лидия Мария Нина Ольга Полина Раиса Софья",
    ("greek", "m"): "Αλέξης Βασίλης Γιάννης Δήμος Ευγένιος Ζήσης Ηλίας Θωμάς Ιάσων Κώστας Λουκάς Μάριος Νίκος Πέτρος Σάββας Τάσος",
    ("greek", "f"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λίνα Μαρία Νίκη Ουρανία Πηνελόπη Σοφία",
}

RESULTS = ["n_entities", "entity_kinds"]
# Rounds after which colliding surrogates grow by a character.
LENGTHENED = 4


def kind_of(value: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        # A value was cut out of its text, so that what must not surround it is gone.
        kind = F.when(value.rlike(rf"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D+", "")


def entity_of(kind: Column, value: Column) -> Column:
    """What is the same in all mentions of an entity."""
    name = F.lower(F.regexp_replace(value, r"^\S+ ", ""))
    gender = F.when(value.rlike(rf"^(?:{_SHE})\b"), F.lit("f ")).otherwise(F.lit("m "))
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "ip", value)
        .when(kind == "name", F.concat(gender, name))
        .otherwise(_digits(value))
    )


def _nibble(hashed: Column, i: Column) -> Column:
    return F.substr(hashed, F.pmod(i, F.lit(64)) + 1, F.lit(1))


def _same_shape(value: Column, hashed: Column) -> Column:
    """Letters and digits replaced by others of their script and case; all else stays."""

    def one(c: Column, i: Column) -> Column:
        new = _nibble(hashed, i)
        return (
            F.when(c.rlike(r"\d"), F.translate(new, _HEX, "0123456789012345"))
            .when(c.rlike("[a-z]"), F.translate(new, _HEX, _LATIN))
            .when(c.rlike("[A-Z]"), F.upper(F.translate(new, _HEX, _LATIN)))
            .when(c.rlike(r"\p{IsCyrillic}"), F.translate(new, _HEX, _CYRILLIC))
            .when(c.rlike(r"\p{IsGreek}"), F.translate(new, _HEX, _GREEK))
            .when(c.rlike(r"\p{L}"), F.translate(new, _HEX, _LATIN))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, _EACH), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a number modulo ten: 0 if it is valid."""
    d = F.transform(F.split(F.reverse(digits), _EACH), lambda c: c.cast("int"))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10))


def _card(digits: Column, hashed: Column) -> Column:
    """As long, of the same network, and as valid as the number."""
    body = F.concat(F.substring(digits, 1, 1), F.substr(_same_shape(digits, hashed), F.lit(2), F.length(digits) - 2))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    other = F.pmod(check + 1 + F.conv(F.substring(hashed, 64, 1), 16, 10).cast("int") % 9, F.lit(10))
    return F.concat(body, F.when(_luhn(digits) == 0, check).otherwise(other).cast("string"))


def _ip(hashed: Column) -> Column:
    octets = [F.conv(F.substring(hashed, 1 + 4 * k, 4), 16, 10).cast("int") % 254 + 1 for k in range(4)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def _more(hashed: Column, longer: Column, letters: str) -> Column:
    """Some characters more, from a part of the hash of its own."""
    return F.translate(F.substr(F.sha2(hashed, 256), F.lit(1), longer), _HEX, letters)


def _name(entity: Column, hashed: Column, longer: Column) -> Column:
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    gender = F.substring(entity, 1, 1)
    given = F.lit("")
    pick = F.conv(F.substring(hashed, 33, 1), 16, 10).cast("int")
    for (s, g), names in NAMES.items():
        own = F.get(F.array(*[F.lit(n) for n in names.split()]), pick)
        given = F.when((script == s) & (gender == g), own).otherwise(given)
    last = F.regexp_extract(entity, r"(\S+)$", 1)
    more = F.lit("")
    for name, letters in (("latin", _LATIN), ("cyrillic", _CYRILLIC), ("greek", _GREEK)):
        more = F.when(script == name, _more(hashed, longer, letters)).otherwise(more)
    family = F.initcap(F.concat(_same_shape(last, hashed), more))
    # A name of one word is a family name.
    return F.when(entity.rlike(r"^\S+ \S+ \S+"), F.concat_ws(" ", given, family)).otherwise(family)


def _keyed(key: str, *values: Column) -> Column:
    """A hash that only those who have the key can make: the key goes in before and after."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), *values), 256)
    return F.sha2(F.concat_ws("|", F.lit(key), inner), 256)


def surrogate_of(kind: Column, entity: Column, hashed: Column, longer: Column) -> Column:
    """The replacement of an entity in its plain form, by some characters longer than the entity."""
    host = F.regexp_replace(F.regexp_extract(entity, "@(.*)$", 1), r"\.[^.]+$", "")
    local = F.concat(_same_shape(F.regexp_extract(entity, "^([^@]*)", 1), hashed), _more(hashed, longer, _LATIN))
    email = F.concat(local, F.lit("@"), _same_shape(host, F.reverse(hashed)), F.lit(".example"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", _ip(hashed))
        .when(kind == "card", _card(entity, hashed))
        .when(kind == "name", _name(entity, hashed, longer))
        .otherwise(F.concat(_same_shape(entity, hashed), _more(hashed, longer, "0123456789012345")))
    )


def _formatted(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate written as the mention was: its separators, its title."""
    # The i-th character of a number, if a digit, is as many digits into it. A country code stays.
    country = F.when(kind == "phone", F.length(F.regexp_extract(value, r"^\+(\d{1,3})[ .(-]", 1))).otherwise(0)

    def one(c: Column, i: Column) -> Column:
        at = F.length(_digits(F.substr(value, F.lit(1), i + 1)))
        return F.when(c.rlike(r"\d") & (at > country), F.substr(surrogate, at, F.lit(1))).otherwise(c)

    # What a surrogate has more digits is written at the end.
    number = F.concat(
        F.array_join(F.transform(F.split(value, _EACH), one), ""),
        F.substr(surrogate, F.length(_digits(value)) + 1, F.length(surrogate)),
    )
    title = F.regexp_extract(value, r"^(\S+ )", 1)
    upper = value == F.upper(value)
    return (
        F.when(kind == "email", F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .when(kind == "ip", surrogate)
        .when(kind == "name", F.concat(title, surrogate))
        .otherwise(number)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): one to one in a kind, and never an entity.

    Of entities with one surrogate the first keeps it; the others try their next one, which in time is longer, so
    that there is always an end.
    """
    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    tried = entities.withColumn("attempt", F.lit(0))
    while True:
        hashed = _keyed(key, F.col("kind"), F.col("entity"), F.col("attempt").cast("string"))
        made = tried.withColumn("hashed", hashed)
        longer = F.floor(F.col("attempt") / LENGTHENED).cast("int")
        made = made.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("entity"), F.col("hashed"), longer)).drop("hashed")
        order = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "entity"))
        made = made.withColumn("at", order).join(real, ["kind", "surrogate"], "left")
        made = made.withColumn("again", (F.col("at") > 1) | F.col("real").isNotNull()).drop("at", "real")
        made, seen = stage(made, "surrogates", again=F.count(F.when(F.col("again"), 1)))
        if not seen["again"]:
            return made.select("kind", "entity", "surrogate")
        tried = made.select("kind", "entity", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


def replace_personal_data(
    docs: DataFrame, key: str, id_: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """`docs` with surrogates in the text, `n_entities` and `entity_kinds`. Who has the key can make the same
    surrogates again."""
    columns = [c for c in kept_columns(docs, [*RESULTS, text], keep)]
    value = F.col(f"`{text}`").cast("string")
    row = F.xxhash64(F.col(f"`{id_}`").cast("string"), value)
    found = F.regexp_extract_all(value, F.lit(ANY), F.lit(0))
    mentions = docs.select(row.alias("row"), F.posexplode(found).alias("at", "value"))
    mentions = mentions.withColumn("kind", kind_of(F.col("value")))
    # A phone number's country code is not part of what is replaced; the whole number tells entities apart.
    mentions = mentions.withColumn("entity", entity_of(F.col("kind"), F.col("value")))
    mentions, _ = stage(mentions.distinct(), "mentions")
    surrogates = assign(mentions.filter("kind is not null").select("kind", "entity").distinct(), key)
    written = mentions.join(surrogates, ["kind", "entity"], "left")
    new = F.coalesce(_formatted(F.col("kind"), F.col("value"), F.col("surrogate")), F.col("value"))
    written = written.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", new.alias("new")))).alias("_new_"),
        F.array_sort(F.collect_set("kind")).alias("entity_kinds"),
        F.count_distinct("kind", "entity").alias("n_entities"),
    ).withColumnRenamed("row", "_row_")
    own = docs.select(*[F.col(f"`{c}`") for c in columns], value.alias("_value_"), row.alias("_key_"))
    joined = own.join(written, F.col("_key_") == F.col("_row_"), "left")
    parts = F.transform(
        F.split("_value_", ANY, -1), lambda s, i: F.concat(s, F.coalesce(F.get(F.col("_new_"), i)["new"], F.lit("")))
    )
    changed = F.when(F.col("_new_").isNull(), F.col("_value_")).otherwise(F.array_join(parts, ""))
    return joined.select(
        *[F.col(f"`{c}`") for c in columns],
        changed.alias(text),
        F.coalesce("n_entities", F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce("entity_kinds", F.array().cast("array<string>")).alias("entity_kinds"),
    )
