"""Personal data replaced by surrogates.

Emails, telephone, card and social security numbers, IBANs, IPv4 and IPv6 addresses and titled
names are found by pattern; a full name that has a title anywhere in a text is also found in that
text without one.  An entity is its kind and its canonical form, so all spellings of one entity, in
all documents, get the same surrogate: a name after an open title has the gender its other titles
in the corpus tell, a family name that one full name of its text ends with is that person's, and
addresses of one domain share its surrogate.  The surrogate is drawn from a keyed hash; it has the kind's
type, the entity's format digit by digit, and a name's gender and script.  Draws that meet an
entity of the corpus, or another entity's surrogate, are drawn again until all are distinct.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.common import staged

# Titles that tell a gender, by language.
MALE_TITLES = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н", "κύριος")
FEMALE_TITLES = (
    "Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta",
    "госпожа", "г-жа", "κυρία",
)
OPEN_TITLES = ("Dr", "Prof")

# Given names by script and gender, and syllables family names are made of.
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Gabriel", "Hugo",
                     "Ivan", "Jonas", "Karl", "Leo", "Martin", "Nils", "Oscar", "Paul"),
    ("latin", "f"): ("Ada", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen",
                     "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("latin", "n"): ("Alex", "Charlie", "Dominique", "Eden", "Frankie", "Gael", "Jamie", "Kim",
                     "Lee", "Morgan", "Noa", "Quinn", "Robin", "Sam", "Sascha", "Toni"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
    ("cyrillic", "n"): ("Саша", "Женя", "Валя", "Шура", "Паша", "Тоня", "Лера", "Миша"),
    ("greek", "m"): ("Άγγελος", "Γιώργος", "Δημήτρης", "Νίκος", "Πέτρος", "Σπύρος"),
    ("greek", "f"): ("Άννα", "Γεωργία", "Δήμητρα", "Ελένη", "Μαρία", "Σοφία"),
    ("greek", "n"): ("Άρης", "Γεώργιος", "Δάφνη", "Λέων", "Μέλπω", "Φοίβος"),
}
SYLLABLES = {
    "latin": ("ba", "ber", "da", "den", "fel", "gar", "hol", "kin", "lan", "mar", "nor", "pel",
              "ros", "sten", "tor", "win"),
    "cyrillic": ("ба", "вер", "гор", "дан", "кол", "лан", "мир", "нов", "пав", "рос", "сол",
                 "тим"),
    "greek": ("βα", "γαρ", "δημ", "καλ", "λαν", "μαρ", "νικ", "παπ", "ρος", "σταυ", "τορ", "φιλ"),
}
FAMILY_SYLLABLES = 3

_TITLES = "|".join(sorted(MALE_TITLES + FEMALE_TITLES + OPEN_TITLES, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{Ll}\p{M}]+(?:[-'’]\p{Lu}[\p{Ll}\p{M}]+)?"

_V4 = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_H = r"[0-9A-Fa-f]{1,4}"
# All eight groups, or one run of zeros left out; the last two may be an IPv4 address.
_V6 = "|".join(
    [rf"(?:{_H}:){{6}}{_V4}", rf"(?:{_H}:){{1,5}}:(?:{_H}:){{0,4}}{_V4}", rf"::(?:{_H}:){{0,5}}{_V4}",
     rf"(?:{_H}:){{7}}{_H}"]
    + [rf"(?:{_H}:){{1,{n}}}(?::{_H}){{1,{7 - n}}}" for n in range(6, 0, -1)]
    + [rf":(?::{_H}){{1,7}}", rf"(?:{_H}:){{1,7}}:"]
)

#: Kind, what may not come before it, and pattern, in the order in which they are tried at a place.
_KINDS = (
    ("email", r"(?<![\p{L}\p{N}])",
     # The lengths mail allows; without them a text of dots is searched again from each dot.
     r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}"),
    ("iban", r"(?<![\p{L}\p{N}_])",
     r"[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?"),
    # A word like a::b has no digit and is none; more groups than eight are none either.
    ("ip6", r"(?<![\p{L}\p{N}_:])(?<!\d\.)(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:])(?=[A-Fa-f:]*[0-9])",
     rf"(?:{_V6})(?!:|\.\d)"),
    # A version of five parts is no address.
    ("ip", r"(?<![\p{L}\p{N}_])(?<!\d\.)", _V4),
    # Digits joined to digits before them are part of a longer number.
    ("card", r"(?<![\p{L}\p{N}_])(?<!\d[.-])",
     r"\d{4}([\x20-]?)\d{4}\1\d{4}\1\d{4}|3[47]\d{2}[\x20-]?\d{6}[\x20-]?\d{5}"),
    ("ssn", r"(?<![\p{L}\p{N}_])(?<!\d[.-])",
     r"(?!000|666)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?!-\d)"
     r"|(?!000|666)\d{3}\x20(?!00)\d{2}\x20(?!0000)\d{4}(?!\x20\d)"),
    ("phone", r"(?<![\p{L}\p{N}_])",
     r"\+1[\x20.-]?\(?\d{3}\)?[\x20.-]?\d{3}[\x20.-]?\d{4}"
     r"|\+\d{1,3}[\x20.-]?\(?\d{2,4}\)?(?:[\x20.-]?\d{2,4}){2,4}"
     r"|(?<!\d[.-])(?:1[\x20.-]?)?\(\d{3}\)\x20?\d{3}[\x20.-]\d{4}"
     r"|(?<!\d[.-])(?:1[.-])?\d{3}[\x20.-]\d{3}[\x20.-]\d{4}"),
    ("name", r"(?<![\p{L}\p{N}_])", rf"(?:{_TITLES})\.?\x20{_NAME}(?:\x20{_NAME}){{0,2}}"),
)
PATTERNS = tuple((kind, pattern) for kind, _, pattern in _KINDS)
_AFTER = r"(?![\p{L}\p{N}_@]|\.\d)"
_TITLED = rf"\A(?:{_TITLES})\.?\x20"


# Only the card's pattern has a group, so its back reference holds in the joined pattern too.
ENTITY = "(?:" + "|".join(f"{before}(?:{pattern})" for _, before, pattern in _KINDS) + ")" + _AFTER

#: What every text with an entity holds: each pattern implies one of these.
HOPEFUL = rf"[0-9]{{2}}|@|[0-9]\.[0-9]|::|[0-9A-Fa-f]:[0-9A-Fa-f]{{1,4}}:|(?:{_TITLES})\.?\x20"


def _kind(entity: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        kind = F.when(entity.rlike(rf"\A(?:{pattern})\z"), F.lit(name)).otherwise(kind)
    return kind


#: International calling codes of one and two digits; all others have three.
_CALLING_CODE = r"\A\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: A number of ten digits with the one before it that calls the same line from farther away.
_WITH_ONE = r"\A\+?1(?:[^0-9]*[0-9]){10}\z"
#: The attempt from which draws come from longer ranges.
LONGER_FROM = 9
#: Partitions a core of the tables of mentions and entities and of the changed texts.
PARTITIONS_A_CORE = 4


def canonical(kind: Column, entity: Column) -> Column:
    """What all spellings of an entity have in common."""
    digits = F.regexp_replace(entity, r"[^\d]", "")
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "iban", F.regexp_replace(entity, r"\x20", ""))
        .when(kind == "ip", entity)
        .when(kind == "ip6", _full_ip6(entity))
        .when(kind == "name", F.concat_ws(":", _gender(entity), _bare(entity)))
        .when((kind == "phone") & entity.rlike(_WITH_ONE), F.substring(digits, 2, 10))
        .when((kind == "phone") & entity.startswith("+"), F.concat(F.lit("+"), digits))
        .otherwise(digits)
    )


def _bare(name: Column) -> Column:
    return F.regexp_replace(name, _TITLED, "")


def _full_ip6(entity: Column) -> Column:
    """All eight groups of an IPv6 address, four digits each."""
    low = F.lower(entity)
    v4 = F.split(F.regexp_extract(low, r"([0-9.]+)\z", 1), r"\.")
    pair = lambda n: F.lpad(F.lower(F.hex(F.get(v4, n).cast("int"))), 2, "0")
    tail = F.concat(pair(0), pair(1), F.lit(":"), pair(2), pair(3))
    low = F.when(
        F.instr(low, ".") > 0, F.concat(F.regexp_replace(low, r"[0-9.]+\z", ""), tail)
    ).otherwise(low)
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    left = groups(F.substring_index(low, "::", 1))
    right = F.when(F.instr(low, "::") > 0, groups(F.substring_index(low, "::", -1))).otherwise(
        F.array().cast("array<string>")
    )
    # Arrays cannot be repeated a negative number of times; eight groups leave none out.
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(
        F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":"
    )


def _title(name: Column) -> Column:
    return F.regexp_extract(name, rf"\A({_TITLES})", 1)


def _gender(name: Column) -> Column:
    title = _title(name)
    return (
        F.when(title.isin(*MALE_TITLES), "m").when(title.isin(*FEMALE_TITLES), "f").otherwise("n")
    )


def _script(name: str) -> Column:
    return (
        F.when(F.col(name).rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(F.col(name).rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _draw(seed: Column, n: int, of: int) -> Column:
    """The n-th number below ``of`` from a hash in hex."""
    # Five digits of the hash at a time; a new hash where one is used up.
    part = F.substring(F.sha2(F.concat(seed, F.lit(f"/{n // 12}")), 256), n % 12 * 5 + 1, 5)
    return F.conv(part, 16, 10).cast("int") % of


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number + 1)


def _in_format(core: Column, seed: Column) -> Column:
    """Digits, lower and upper case letters each replaced by one of their own sort."""
    stream = F.concat(*[F.sha2(F.concat(seed, F.lit(f"#{i}")), 256) for i in range(2)])

    def other(char: Column, at: Column) -> Column:
        number = F.conv(F.substring(stream, at % 60 * 2 + 1, 4), 16, 10).cast("int")
        letter = number % 26
        return (
            F.when(char.rlike("[0-9]"), (number % 10).cast("string"))
            .when(char.rlike("[a-z]"), F.char(letter + 97))
            .when(char.rlike("[A-Z]"), F.char(letter + 65))
            .otherwise(char)
        )

    chars = F.filter(F.split(core, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, other), "")


def _surrogate(seed: Column, key: str) -> Column:
    """A draw for the row's (kind, entity): the canonical surrogate."""
    entity = F.col("entity")
    # Where values of this length are used up, one digit more a round makes room for ten times
    # as many: every round with open entities comes nearer to the last.
    more = F.repeat(F.lit("0"), F.greatest(F.col("attempt") - (LONGER_FROM - 1), F.lit(0)))
    more = _in_format(more, F.concat(seed, F.lit("+")))
    # The domain's part depends on the domain alone.
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.substring_index(entity, "@", -1)), 256)
    email = F.concat(
        _in_format(F.substring_index(entity, "@", 1), seed),
        more,
        F.lit("@mail-"),
        F.substring(domain, 1, 16),
        F.lit(".example.net"),
    )
    # The prefix of documentation, then 96 bits.
    ip6 = F.concat_ws(
        ":",
        F.lit("2001:0db8"),
        *[F.lpad(F.lower(F.hex(_draw(seed, n, 65536))), 4, "0") for n in range(6)],
    )
    # Documentation addresses would be too few; 10/8 is private and holds 16 million, the range
    # kept for the future 268 million; beyond these an address is of the longer sort.
    octets = [_draw(seed, n, 256).cast("string") for n in range(3)]
    later = (_draw(seed, 3, 16) + 240).cast("string")
    ip = (
        F.when(F.col("attempt") < 4, F.concat_ws(".", F.lit("10"), *octets))
        .when(F.col("attempt") < LONGER_FROM, F.concat_ws(".", later, *octets))
        .otherwise(ip6)
    )
    # The country and the check digits' place stay as they are.
    iban = F.concat(
        F.substring(entity, 1, 2), _in_format(F.expr("substring(entity, 3)"), seed), more
    )
    # The calling code stays, or the first digit, which tells a network or a region.
    lead = F.when(entity.startswith("+"), F.regexp_extract(entity, _CALLING_CODE, 0)).otherwise(
        F.substring(entity, 1, 1)
    )
    rest = F.substring(entity, F.char_length(lead) + 1, F.char_length(entity))
    number = F.concat(lead, _in_format(rest, seed), more)
    name = F.lit(None).cast("string")
    for (script, gender), given in GIVEN.items():
        family = F.initcap(
            F.concat(
                *[
                    _pick(SYLLABLES[script], _draw(seed, n + 1, len(SYLLABLES[script])))
                    for n in range(FAMILY_SYLLABLES)
                ],
                # Later attempts have longer names, so there are always enough.
                F.when(
                    F.col("attempt") > 3,
                    F.array_join(
                        F.transform(
                            F.sequence(F.lit(1), F.col("attempt") - 3),
                            lambda n: F.element_at(
                                F.array(*[F.lit(x) for x in SYLLABLES[script]]),
                                F.pmod(F.xxhash64(seed, n), F.lit(len(SYLLABLES[script]))).cast(
                                    "int"
                                )
                                + 1,
                            ),
                        ),
                        "",
                    ),
                ).otherwise(""),
            )
        )
        full = F.concat(_pick(given, _draw(seed, 0, len(given))), F.lit(" "), family)
        fits = (F.col("script") == script) & (F.substring("entity", 1, 1) == gender)
        name = F.when(fits, F.concat(F.lit(f"{gender}:"), full)).otherwise(name)
    kind = F.col("kind")
    return (
        F.when(kind == "email", F.lower(email))
        .when(kind == "ip", ip)
        .when(kind == "ip6", ip6)
        .when(kind == "iban", iban)
        .when(kind == "name", name)
        .otherwise(number)
    )


def _few(df: DataFrame) -> DataFrame:
    """``df`` in a few partitions a core, however many its shuffles have.

    Rows of mentions are few: a file for each partition is thousands of tiny files, and on a local
    file system without Hadoop's native library each starts processes that, until they run their
    own program, count the executor's whole memory once more.  The partitions below keep their
    size and are read one after the other.
    """
    return df.coalesce(PARTITIONS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Rows (kind, entity, surrogate) for distinct (kind, entity); all surrogates distinct.

    In each round every open entity draws.  A draw that is an entity of the corpus is void;
    of several that draw the same the one with the smallest hash has it.  Who is left without
    draws again in the next round, from another hash.
    """
    entities = entities.withColumn("script", _script("entity"))
    open_ = entities.withColumn("attempt", F.lit(0))
    taken = None
    while True:
        seed = F.sha2(F.concat_ws("|", F.lit(key), "kind", "entity", F.col("attempt")), 256)
        drawn = open_.withColumn("seed", seed).withColumn("surrogate", _surrogate(F.col("seed"), key))
        used = entities.select("kind", F.col("entity").alias("surrogate"))
        if taken is not None:
            used = used.unionByName(taken.select("kind", "surrogate"))
        # Both sides of this join are distinct; the draws of one surrogate are all void or none.
        drawn = drawn.join(used.withColumn("void", F.lit(True)), ["kind", "surrogate"], "left")
        first = F.row_number().over(
            Window.partitionBy("kind", "surrogate").orderBy("seed", "entity")
        )
        drawn = drawn.withColumn("won", F.col("void").isNull() & (first == 1)).select(
            "kind", "entity", "script", "attempt", "surrogate", "won"
        )
        drawn = staged(_few(drawn), "pii-drawn")
        won = drawn.where("won").select("kind", "entity", "surrogate")
        if taken is None:
            # The first round's table holds every entity.
            entities = drawn.select("kind", "entity")
        taken = won if taken is None else taken.unionByName(won)
        open_ = drawn.where(~F.col("won")).select(
            "kind", "entity", "script", (F.col("attempt") + 1).alias("attempt")
        )
        if open_.isEmpty():
            return taken


def _name_mentions(mentions: DataFrame) -> DataFrame:
    """Mentions (row_id, at, kind, found) of names with their entity, and whether by family name.

    A single word is the family name of the one full name of its text that ends with it and
    has no other gender.  A name without a telling title has the gender that all telling titles
    of that name in the corpus agree on.
    """
    names = mentions.where("kind = 'name'").withColumns(
        {"gender": _gender(F.col("found")), "bare": _bare(F.col("found"))}
    )
    is_full = F.col("bare").contains(" ")
    full = (
        names.where(is_full)
        .groupBy("row_id", "bare")
        .agg(F.collect_set(F.when(F.col("gender") != "n", F.col("gender"))).alias("genders"))
        .select(
            F.col("row_id").alias("in_row"),
            F.substring_index("bare", " ", -1).alias("family"),
            F.col("bare").alias("full"),
            "genders",
        )
    )
    fits = (
        (F.col("row_id") == F.col("in_row"))
        & (F.col("bare") == F.col("family"))
        & ((F.col("gender") == "n") | (F.size("genders") == 0)
           | F.array_contains("genders", F.col("gender")))
    )
    alone = names.where(~is_full).join(full, fits, "left")
    alone = alone.groupBy("row_id", "at", "found", "gender", "bare").agg(
        F.count("full").alias("n"), F.min("full").alias("full")
    )
    alone = alone.withColumn("family_only", F.col("n") == 1).withColumn(
        "bare", F.when(F.col("n") == 1, F.col("full")).otherwise(F.col("bare"))
    )
    columns = ["row_id", "at", "found", "gender", "bare", "family_only"]
    named = names.where(is_full).withColumn("family_only", F.lit(False)).select(columns)
    named = named.unionByName(alone.select(columns))
    told = (
        named.where("gender <> 'n'")
        .groupBy("bare")
        .agg(F.min("gender").alias("told"), F.max("gender").alias("other"))
        .where("told = other")
        .select("bare", "told")
    )
    gender = F.when(F.col("gender") == "n", F.coalesce("told", F.lit("n"))).otherwise(F.col("gender"))
    return named.join(told, "bare", "left").select(
        "row_id",
        "at",
        "found",
        F.lit("name").alias("kind"),
        F.concat_ws(":", gender, "bare").alias("entity"),
        "family_only",
    )


def _spelled(kind: Column, found: Column, surrogate: Column, family_only: Column) -> Column:
    """The canonical surrogate in the spelling in which the entity was found."""
    name = F.expr("substring(surrogate, 3)")
    name = F.when(family_only, F.substring_index(name, " ", -1)).otherwise(name)
    far = (kind == "phone") & found.rlike(_WITH_ONE)
    one = F.when(far, F.regexp_extract(found, r"\A\+?1", 0)).otherwise("")
    rest = F.substring(found, F.char_length(one) + 1, F.char_length(found))
    surrogate = F.when(kind == "phone", F.ltrim(surrogate, F.lit("+"))).otherwise(surrogate)
    chars = F.filter(F.split(rest, ""), lambda c: c != "")
    # Digits and letters take the surrogate's in turn; what lies between them stays.
    marks = F.transform(chars, lambda c: c.rlike("[A-Za-z0-9]").cast("int"))
    shaped = F.aggregate(
        F.arrays_zip(chars.alias("c"), marks.alias("m")),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("used")),
        lambda done, x: F.struct(
            F.concat(
                done["text"],
                F.when(x["m"] == 1, F.substring(surrogate, done["used"] + 1, F.lit(1))).otherwise(
                    x["c"]
                ),
            ).alias("text"),
            (done["used"] + x["m"]).alias("used"),
        ),
        lambda done: F.concat(
            done["text"], F.substring(surrogate, done["used"] + 1, F.char_length(surrogate))
        ),
    )
    title = F.regexp_extract(found, rf"\A((?:{_TITLES})\.?\x20)", 1)
    return (
        F.when(kind.isin("email", "ip", "ip6"), surrogate)
        .when(kind == "name", F.concat(title, name))
        .otherwise(F.concat(one, shaped))
    )


def _with_names(found: Column) -> Column:
    """The pattern of a text's entities: all kinds, and its titled full names without their title."""
    full = F.filter(
        F.transform(F.filter(found, lambda x: x.rlike(_TITLED)), _bare), lambda x: x.contains(" ")
    )
    # Longer names first: a shorter one may begin a longer.
    names = F.transform(
        F.sort_array(
            F.transform(F.array_distinct(full), lambda x: F.struct(F.char_length(x).alias("n"), x.alias("x"))),
            asc=False,
        ),
        lambda x: x["x"],
    )
    # A name is letters, marks, hyphens, apostrophes and blanks: nothing a pattern reads otherwise.
    untitled = F.concat(
        F.lit(ENTITY + r"|(?<![\p{L}\p{N}_])(?=\p{Lu})(?:"),
        F.array_join(names, "|"),
        F.lit(")" + _AFTER),
    )
    return F.when(F.size(names) > 0, untitled).otherwise(F.lit(ENTITY))


def surrogates(
    documents: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``documents``: doc_id, text, n_entities, entities.

    ``text`` has every entity replaced; ``entities`` lists (kind, start, end, surrogate) in the
    order of the original text, in code points, the end exclusive.  Equal entities get equal
    surrogates, different ones different surrogates, in the whole table; a person's family name
    alone is given the surrogate's.  A null text stays
    null and has no entities, like an empty one.  Rows that repeat an id are rows of their own;
    other columns are ignored; an empty table gives no rows.
    """
    # One pass finds the entities; texts without any take no part in the joins.
    rows = staged(
        documents.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(text_col).cast("string").alias("text"),
        ).withColumn(
            "found",
            F.when(
                F.col("text").rlike(HOPEFUL),
                F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)),
            ).otherwise(F.array().cast("array<string>")),
        )
        .withColumn("pattern", _with_names(F.col("found")))
        .withColumn(
            "found",
            F.when(
                F.col("pattern") != ENTITY,
                F.regexp_extract_all("text", F.col("pattern"), F.lit(0)),
            ).otherwise(F.col("found")),
        ),
        "pii-rows",
        small_pages=True,
    )
    hit = rows.where(F.size("found") > 0)
    # What no pattern of a kind fits is a name without its title.
    kind = F.coalesce(_kind(F.col("found")), F.lit("name"))
    seen = hit.select("row_id", F.posexplode("found").alias("at", "found")).withColumn("kind", kind)
    seen = staged(_few(seen), "pii-seen")
    others = seen.where("kind <> 'name'").withColumns(
        {"entity": canonical(F.col("kind"), F.col("found")), "family_only": F.lit(False)}
    )
    mentions = staged(_few(others.unionByName(_name_mentions(seen))), "pii-mentions")
    assigned = assign_surrogates(mentions.select("kind", "entity").distinct(), key)
    replaced = (
        mentions.join(assigned, ["kind", "entity"])
        .groupBy("row_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "at",
                        "kind",
                        F.char_length("found").alias("size"),
                        _spelled(
                            F.col("kind"), F.col("found"), F.col("surrogate"), F.col("family_only")
                        ).alias("put"),
                    )
                )
            ).alias("r")
        )
    )
    between = F.split("text", F.col("pattern"), -1)
    text = F.concat(
        F.array_join(
            F.transform("r", lambda x, n: F.concat(F.get("gaps", n), x["put"])), ""
        ),
        F.element_at("gaps", -1),
    )
    starts = F.aggregate(
        "r",
        F.struct(
            F.lit(0).alias("at"),
            F.expr("cast(array() as array<struct<kind:string,start:int,end:int,surrogate:string>>)")
            .alias("list"),
        ),
        lambda done, x: F.struct(
            (done["at"] + F.char_length(F.get("gaps", x["at"])) + x["size"]).alias("at"),
            F.array_append(
                done["list"],
                F.struct(
                    x["kind"].alias("kind"),
                    (done["at"] + F.char_length(F.get("gaps", x["at"]))).alias("start"),
                    (done["at"] + F.char_length(F.get("gaps", x["at"])) + x["size"]).alias("end"),
                    x["put"].alias("surrogate"),
                ),
            ).alias("list"),
        ),
        lambda done: done["list"],
    )
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,surrogate:string>>)")
    changed = (
        hit.join(replaced, "row_id")
        .withColumn("gaps", between)
        .select("doc_id", text.alias("text"), F.size("r").alias("n_entities"),
                starts.alias("entities"))
    )
    same = rows.where(F.size("found") == 0).select(
        "doc_id", "text", F.lit(0).alias("n_entities"), none.alias("entities")
    )
    return same.unionByName(_few(changed))
