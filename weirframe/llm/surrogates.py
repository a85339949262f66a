"""Personal data and secrets replaced by keyed surrogates, in DataFrame functions alone.

Detection is one regular expression (``ENTITY``): e-mail addresses, IPv4 and IPv6 addresses,
phone, card, passport and social security numbers, IBANs, access keys and private key blocks,
assigned passwords and tokens however long, and names behind a title. ``HINT`` is a quick
test that every such text passes, so most texts are never searched. A match falls into parts;
some are kept (a title, the name of an assigned secret), the others are replaced.

A surrogate is derived from a keyed SHA-512 of the part's kind and canonical value, so
one value has one surrogate in all documents (coreference), and has the value's form:
digits for digits, letters of the same script and case, the same punctuation, country code,
card scheme, valid check digits of cards and IBANs, script and gender of a name. Words of an
e-mail address that are names found elsewhere become those names' surrogates; addresses of
one domain stay in one domain.

Distinctness is checked over all values found. A surrogate that two values of a kind share
goes to the least value, and none may be itself a value found; the values left over are
derived anew with the next attempt number. Settled ones are not touched again. Where the form
has no room left, surrogates get longer after ``WIDEN`` attempts (an IPv4 address becomes an
IPv6 one), so this ends even if all values of a form occur.

Only documents with a match are shuffled, and joined with their surrogates by a digest
of their list of matches, so copies of a document are joined once. All others pass
through.

Nulls: a null text stays null. Empty texts and texts without a match are unchanged, and very
long ones are searched whole. Repeated rows are replaced alike. All columns are kept, whatever
their names; an empty table stays empty. ``key`` is a secret of the caller: whoever has it can
rebuild the table of surrogates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import unused
from weirframe.session import Scratch

#: Attempts after which surrogates get longer than their values.
WIDEN = 6
# Titles of men, of women and of either, in the languages and scripts covered.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Господин", "Κύριος")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Г-жа", "Госпожа", "Κυρία")
OTHER_TITLES = ("Dr", "Prof", "Доктор", "Δρ")
# Onset and vowel letters from which names of each script are made, and endings by gender.
SYLLABLES = {
    "latin": ("bdfglmnprstvkjhz", "aeiouaei", "a", "o"),
    "cyrillic": ("бвгдзклмнпрстфжх", "аеиоуяеи", "а", "й"),
    "greek": ("βγδζθκλμνπρστφχψ", "αειουηωα", "α", "ς"),
}
OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Letters that stand in for those of other scripts: some of each script's block.
SCRIPT_LETTERS = {
    r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшщыэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "".join(chr(0x4E00 + 37 * k) for k in range(200)),
    r"\p{IsHiragana}": "".join(chr(0x304B + k) for k in range(40)),
    r"\p{IsKatakana}": "".join(chr(0x30AB + k) for k in range(40)),
    r"\p{IsHangul}": "".join(chr(0xAC00 + 53 * k) for k in range(200)),
    r"\p{IsArabic}": "".join(chr(0x0628 + k) for k in range(18)),
    r"\p{IsHebrew}": "".join(chr(0x05D0 + k) for k in range(22)),
    r"\p{IsDevanagari}": "".join(chr(0x0915 + k) for k in range(30)),
    r"\p{IsThai}": "".join(chr(0x0E01 + k) for k in range(40)),
}
TITLE = "|".join(sorted({*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES}, key=lambda title: (-len(title), title)))
NAME = r"\p{Lu}[\p{L}'’-]{1,40}"
HEX = "[0-9A-Fa-f]{1,4}"
# Up to the closing quote, or else up to white space but for closing marks; with four letters or digits at least.
SECRET = (
    r"\"(?=(?:[^\"\n\p{L}0-9]*+[\p{L}0-9]){4})[^\"\n]{8,}+(?=\"|$)|'(?=(?:[^'\n\p{L}0-9]*+[\p{L}0-9]){4})[^'\n]{8,}+(?='|$)"
    r"|[\"']?(?=(?:[^\s\"'\p{L}0-9]*+[\p{L}0-9]){4})[^\s\"']{7,}[^\s\"'.,;)]"
)
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "token": r"gh[pousr]_[A-Za-z0-9]{20,}+|[sp]k_(?:live|test)_[A-Za-z0-9]{10,}+",
    "pem": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+-----END [A-Z ]{0,30}PRIVATE KEY-----",
    "passport": r"(?i:passport)(?: (?i:no|num|number)\b\.?)?\s{0,3}[:#]?\s{0,3}(?=[A-Z]{0,3}[0-9])[A-Z0-9]{6,9}(?![A-Za-z0-9])",
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}(?:" + SECRET + ")",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9]\.){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "ip6": rf"(?<!:)(?:(?:{HEX}:){{7}}{HEX}|(?=[A-Fa-f:]{{0,40}}[0-9])(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}|(?=[A-Fa-f:]{{0,40}}[0-9])(?:{HEX}:){{2,7}}:)"
    r"(?![0-9A-Za-z]|:[0-9A-Fa-f:])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # With +; three groups of 3, 3 and 4; with brackets; with a leading 0, in groups that are no date, or without groups.
    "phone": r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\+(?:\(?[0-9]\)?[ ./-]?){6,15}[0-9](?![0-9])"
    r"|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|\((?=(?:[^0-9]{0,2}[0-9]){7})[0-9]{2,5}\)[ .-]?[0-9]{1,8}(?:[ .-][0-9]{2,8}){0,4}(?![0-9])"
    r"|(?<![0-9][ .-])(?!0[0-9][ .-][0-9]{2}[ .-][0-9]{4}(?![0-9]|[ .-][0-9]))(?=(?:[^0-9]?[0-9]){7})0[0-9]{1,4}(?:[ ./-][0-9]{2,8}){1,4}(?![0-9])"
    r"|0[1-9][0-9]{7,9}(?![0-9])|[2-9][0-9]{2}-[0-9]{4}(?![0-9-])|[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9])",
    "card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?![0-9])",
    "person": rf"(?:{TITLE})\.? {NAME}(?: {NAME})?",
}
# Addresses, keys and numbers may stand right behind a letter of another script, titles not.
ENTITY = (
    r"(?<![A-Za-z0-9])(?=[\p{L}0-9+(]|-----B)(?:"
    + "|".join(rf"(?<!\p{{L}})(?:{pattern})" if kind == "person" else pattern for kind, pattern in PATTERNS.items())
    + ")"
)
_FIRST = "".join(sorted({title[0] for title in (*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES)} | {"A"}))
#: What every match contains; much quicker to look for, since most characters fail at once.
HINT = rf"[0-9@=:_]|-----B|(?=[{_FIRST}])(?:AKIA|(?:{TITLE})\.? \p{{Lu}})"
KEPT, NUMBER = "kept", "number"
#: Stands between the digits of an address and the rest of it.
BESIDE = "\u0001"
NAMES = ("family", "given_m", "given_f", "given_n", "local")


def _matches(text: Column, kind: str) -> Column:
    return text.rlike(f"^(?:{PATTERNS[kind]})$")


def _part(kind: Column | str, value: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))


def parts_of(entity: Column) -> Column:
    """The parts of a match, in order: what is kept, and kind and value of what is replaced."""
    assigned = r"^([A-Za-z_-]+\s*[=:]\s*[\"']?)(.*)$"
    named = rf"^((?:{TITLE})\.? )({NAME})(?:( )({NAME}))?$"
    title = F.rtrim(F.translate(F.regexp_extract(entity, named, 1), ".", ""))
    gender = F.when(title.isin(*MALE_TITLES), "m").when(title.isin(*OTHER_TITLES), "n").otherwise("f")
    first, second = F.regexp_extract(entity, named, 2), F.regexp_extract(entity, named, 4)
    person = F.when(
        second == "", F.array(_part(KEPT, F.regexp_extract(entity, named, 1)), _part("family", first))
    ).otherwise(
        F.array(
            _part(KEPT, F.regexp_extract(entity, named, 1)),
            _part(F.concat(F.lit("given_"), gender), first),
            _part(KEPT, F.lit(" ")),
            _part("family", second),
        )
    )
    cases = F.when(_matches(entity, "email"), _address_parts(entity))
    for kind, cut in (("token", r"^([a-z]+_(?:live_|test_)?)(.*)$"), ("passport", r"(?s)^(.*?)([A-Z0-9]{6,9})$")):
        kept, own = F.regexp_extract(entity, cut, 1), F.regexp_extract(entity, cut, 2)
        cases = cases.when(_matches(entity, kind), F.array(_part(KEPT, kept), _part(kind, own)))
    frame = r"(?s)^(-----BEGIN [A-Z ]+-----)(.*)(-----END [A-Z ]+-----)$"
    block = [F.regexp_extract(entity, frame, k) for k in (1, 2, 3)]
    cases = cases.when(_matches(entity, "pem"), F.array(_part(KEPT, block[0]), _part("pem", block[1]), _part(KEPT, block[2])))
    cases = cases.when(
        _matches(entity, "key"), F.array(_part(KEPT, F.substring(entity, 1, 4)), _part("key", F.substring(entity, 5, 16)))
    )
    cases = cases.when(
        _matches(entity, "secret"),
        F.array(
            _part(KEPT, F.regexp_extract(entity, assigned, 1)), _part("secret", F.regexp_extract(entity, assigned, 2))
        ),
    )
    for kind in ("iban", "ip", "ip6", "ssn", "phone", "card"):
        cases = cases.when(_matches(entity, kind), F.array(_part(kind, entity)))
    return cases.otherwise(person)


def _address_parts(address: Column) -> Column:
    """Words of the local part, what stands between them, and the domain."""
    words = F.regexp_extract_all(F.substring_index(address, "@", 1), F.lit("[A-Za-z]+|[^A-Za-z]+"), F.lit(0))

    # Digits are shifted by the rest of the address, so they need it.
    rest_of_it = F.concat(F.lit(BESIDE), F.lower(F.regexp_replace(address, "[0-9]", "")))

    def part(word: Column) -> Column:
        kind = F.when(word.rlike("^[A-Za-z]{2}"), "local").when(word.rlike("[0-9]"), NUMBER).otherwise(KEPT)
        return _part(kind, F.when(word.rlike("[0-9]"), F.concat(word, rest_of_it)).otherwise(word))

    rest = F.array(_part(KEPT, F.lit("@")), _part("domain", F.substring_index(address, "@", -1)))
    return F.concat(F.transform(words, part), rest)


def _shifted(value: Column, key: str) -> Column:
    """Digits of an address, each moved on by 1 to 9 for its place.

    The shifts depend on the address without its digits. So addresses that differ in digits
    alone still differ, and no digit stays, however many such addresses there are.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(NUMBER), F.substring_index(value, BESIDE, -1)), 512)

    def moved(char: Column, at: Column) -> Column:
        step = F.conv(F.substr(digest, F.pmod(at, F.lit(127)) + 1, F.lit(2)), 16, 10).cast("int") % 9 + 1
        return F.when(char.rlike("[0-9]"), ((F.ascii(char) - 48 + step) % 10).cast("string")).otherwise(char)

    return F.array_join(F.transform(F.split(F.substring_index(value, BESIDE, 1), ""), moved), "")


def canonical(kind: Column, value: Column) -> Column:
    """What two mentions of one thing have in common."""
    return F.when(kind.isin("domain", *NAMES), F.lower(value)).otherwise(value)


def _like(value: Column, digest: Column) -> Column:
    """Digits for digits and letters for letters of the same script and case; all else stays."""
    digits = F.translate(digest, "abcdef", "271936")
    letters = F.translate(digest, "0123456789abcdef", "gkmqrtvwxyzbdhns")
    lower_hex = value.rlike("^[0-9a-f]+$") & value.rlike("[a-f]")

    def letter(char: Column, at: Column) -> Column:
        place = F.pmod(at, F.lit(127)) + 1
        number = F.conv(F.substr(digest, place, F.lit(2)), 16, 10).cast("int")
        made = (
            F.when(char.rlike("[0-9a-f]") & lower_hex, F.substr(digest, place, F.lit(1)))
            .when(char.rlike("[0-9]"), F.substr(digits, place, F.lit(1)))
            .when(char.rlike("[A-Z]"), F.upper(F.substr(letters, place, F.lit(1))))
            .when(char.rlike("[a-z]"), F.substr(letters, place, F.lit(1)))
        )
        for script, alphabet in SCRIPT_LETTERS.items():
            own = F.substr(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))
            made = made.when(char.rlike(script) & char.rlike(r"\p{L}"), F.when(char.rlike(r"\p{Lu}"), F.upper(own)).otherwise(own))
        return made.when(char.rlike(r"\p{L}"), F.substr(letters, place, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.split(value, ""), letter), "")


def luhn_sum(value: Column) -> Column:
    """Checksum of the digits of a card number, modulo 10."""
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")

    def weight(char: Column, at: Column) -> Column:
        digit = F.when(char == "", 0).otherwise(F.ascii(char) - 48)
        return F.when(at % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.transform(digits, weight), F.lit(0), lambda a, b: a + b) % 10


def _card(value: Column, digest: Column) -> Column:
    """The same first digit and grouping; as valid as the value was."""
    raw = F.concat(F.substring(value, 1, 1), _like(_from(value, 2), digest))
    head = F.concat(_until_last(raw), F.lit("0"))
    check = F.pmod(F.lit(10) - luhn_sum(head), F.lit(10)).cast("string")
    return F.when(luhn_sum(value) == 0, F.concat(_until_last(raw), check)).otherwise(raw)


def _from(value: Column, start: int) -> Column:
    return F.substr(value, F.lit(start), F.greatest(F.length(value) - start + 1, F.lit(0)))


def _until_last(value: Column) -> Column:
    return F.substr(value, F.lit(1), F.greatest(F.length(value) - 1, F.lit(0)))


def _phone(value: Column, digest: Column) -> Column:
    code = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?![0-9]))", 1)
    return F.concat(code, _like(F.substr(value, F.length(code) + 1, F.length(value)), digest))


def _byte(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, 2 * at + 1, 2), 16, 10).cast("int")


def _ip(digest: Column) -> Column:
    return F.concat_ws(".", *[(_byte(digest, at) % 254 + 1).cast("string") for at in range(4)])


def _ip6(digest: Column) -> Column:
    """An address of the block set aside for examples."""
    return F.concat_ws(":", F.lit("2001:db8"), *[F.substring(digest, 4 * at + 1, 4) for at in range(6)])


def _domain(value: Column, digest: Column) -> Column:
    """Labels of the same form below the domain that is set aside for examples."""
    last = F.length(F.substring_index(value, ".", -1))
    labels = F.substr(value, F.lit(1), F.greatest(F.length(value) - last, F.lit(0)))
    return F.concat(_like(labels, digest), F.lit("example"))


def mod97(text: Column) -> Column:
    """The number that digits and letters (A is 10) spell, modulo 97."""
    chars = F.filter(F.split(text, ""), lambda char: char != "")

    def step(rest: Column, char: Column) -> Column:
        letter = rest * 100 + F.ascii(char) - 55
        return F.when(char.rlike("[0-9]"), rest * 10 + F.ascii(char) - 48).otherwise(letter) % 97

    return F.aggregate(chars, F.lit(0), step)


def _iban(value: Column, digest: Column) -> Column:
    """The same country and grouping; check digits as valid as the value's were."""
    compact = F.translate(value, " ", "")
    country = F.substring(value, 1, 2)
    rest = _like(_from(value, 5), digest)
    sound = mod97(F.concat(_from(compact, 5), F.substring(compact, 1, 4))) == 1
    check = F.lit(98) - mod97(F.concat(F.translate(rest, " ", ""), country, F.lit("00")))
    any_digits = _like(F.substring(value, 3, 2), F.reverse(digest))
    return F.concat(country, F.when(sound, F.lpad(check.cast("string"), 2, "0")).otherwise(any_digits), rest)


def script_of(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(kind: Column, value: Column, digest: Column, attempt: Column) -> Column:
    """A made-up name of three syllables, one more with each two attempts, with the gender's ending."""

    def made(script: str) -> Column:
        onsets, vowels, female, male = SYLLABLES[script]

        def syllable(at: Column) -> Column:
            onset = F.conv(F.substr(digest, 2 * at + 1, F.lit(1)), 16, 10).cast("int")
            vowel = F.conv(F.substr(digest, 2 * at + 2, F.lit(1)), 16, 10).cast("int") % 8
            return F.concat(F.substr(F.lit(onsets), onset + 1, F.lit(1)), F.substr(F.lit(vowels), vowel + 1, F.lit(1)))

        count = F.least(F.lit(3) + F.floor(attempt / 2), F.lit(30)).cast("int")
        ending = F.when(kind == "given_f", female).when(kind == "given_m", male).otherwise("")
        return F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(0), count - 1), syllable), ""), ending))

    script = script_of(value)
    return reduce(
        lambda made_so_far, name: made_so_far.when(script == name, made(name)),
        ("cyrillic", "greek"),
        F.when(script == "latin", made("latin")),
    )


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Keyed surrogate of a canonical value, by kind and attempt; longer after ``WIDEN`` attempts."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value), 512)
    more = F.greatest(attempt - WIDEN, F.lit(0))
    wide = F.concat(F.when(kind == "domain", F.repeat(F.lit("a"), more)).otherwise(""), value, F.when(kind == "domain", "").otherwise(F.repeat(F.lit("0"), more)))
    return (
        F.when(kind == "domain", _domain(wide, digest))
        .when(kind == "iban", _iban(wide, digest))
        .when((kind == "ip") & (more == 0), _ip(digest))
        .when(kind.isin("ip", "ip6"), _ip6(digest))
        .when(kind == "phone", _phone(wide, digest))
        .when(kind == "card", _card(wide, digest))
        .when(kind.isin(*NAMES), _name(kind, value, digest, attempt))
        .otherwise(_like(wide, digest))
    )


def assign(values: DataFrame, scratch: Scratch, key: str, derive=surrogate) -> DataFrame:
    """``kind``, ``value`` and a ``surrogate`` for each distinct ``kind, value``, free of collisions.

    Names of all kinds share one space, other kinds have their own.
    """
    space = F.when(F.col("kind").isin(*NAMES), "name").otherwise(F.col("kind")).alias("space")
    left = scratch.keep(values.select("kind", "value", space).distinct(), "values")
    taken = scratch.keep(left.select("space", F.lower("value").alias("text")).distinct(), "taken")
    settled, step = None, 0
    while True:
        drawn = derive(F.col("kind"), F.col("value"), F.lit(step), key)
        made = left.select("kind", "value", "space", drawn.alias("surrogate")).withColumn("text", F.lower("surrogate"))
        made = scratch.keep(made, f"made-{step}")
        # The values and what is settled are read once; what is looked up in them shrinks from step to step.
        used = taken if settled is None else taken.union(settled.select("space", "text"))
        bad = used.join(made.select("space", "text").distinct(), ["space", "text"], "left_semi")
        owner = made.groupBy("space", "text").agg(F.min(F.struct("value", "kind")).alias("owner"))
        good = made.join(owner, ["space", "text"]).filter(F.col("owner") == F.struct("value", "kind"))
        good = scratch.keep(good.join(bad, ["space", "text"], "left_anti").select("kind", "value", "space", "surrogate", "text"), f"settled-{step}")
        settled = good if settled is None else settled.union(good)
        left = scratch.keep(made.join(good.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value", "space"), f"left-{step}")
        step += 1
        if left.isEmpty():
            return settled.select("kind", "value", "surrogate")


def _with_names(mapped: DataFrame) -> DataFrame:
    """Words of addresses take the surrogate of the name that they are, where there is one."""
    order = F.when(F.col("kind") == "family", 0).otherwise(1)
    names = mapped.filter(F.col("kind").isin(*NAMES) & (F.col("kind") != "local"))
    best = names.groupBy("value").agg(F.min(F.struct(order, "kind", "surrogate")).alias("best"))
    words = mapped.filter("kind = 'local'").join(best, "value", "left")
    return mapped.filter("kind <> 'local'").unionByName(
        words.select("kind", "value", F.coalesce("best.surrogate", "surrogate").alias("surrogate"))
    )


def pseudonymise(
    docs: DataFrame, scratch: Scratch, key: str, text_col: str = "text", length_col: str | None = None,
    count_col: str | None = None,
) -> DataFrame:
    """``docs`` with surrogates in ``text_col``, derived with the secret ``key``.

    ``length_col`` is set to the new length where the text changes; ``count_col`` is
    added with the number of matches.
    """
    columns = docs.columns
    found, digest, made = unused(docs, "found"), unused(docs, "digest"), unused(docs, "made")
    text = F.col(text_col)
    hit = F.coalesce(F.when(text.rlike(HINT), text.rlike(ENTITY)), F.lit(False))
    plain = docs.filter(~hit)
    matches = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    marked = docs.filter(hit).withColumn(found, matches)
    marked = scratch.keep(
        marked.withColumn(digest, F.sha2(F.concat_ws("\u0001", F.col(found)), 256)), "matched"
    )
    lists = marked.select(F.col(digest).alias("digest"), F.col(found).alias("found")).distinct()
    each = lists.select("digest", F.posexplode("found").alias("at", "entity"))
    parts = each.select("digest", "at", F.posexplode(parts_of(F.col("entity"))).alias("part_at", "part")).select(
        "digest", "at", "part_at", "part.kind", F.col("part.value").alias("written"),
        canonical(F.col("part.kind"), F.col("part.value")).alias("value"),
    )
    parts = scratch.keep(parts, "parts")
    mapped = _with_names(assign(parts.filter(~F.col("kind").isin(KEPT, NUMBER)), scratch, key))
    small = (F.col("kind") == "local") & F.col("written").rlike("^[a-z]")
    shown = F.when(small, F.lower("surrogate")).otherwise(F.col("surrogate"))
    replaced = parts.join(mapped, ["kind", "value"], "left").select(
        "digest", "at", "part_at",
        F.when(F.col("kind") == NUMBER, _shifted(F.col("written"), key)).otherwise(F.coalesce(shown, F.col("written"))).alias("text"),
    )
    entities = replaced.groupBy("digest", "at").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("part_at", "text"))), lambda part: part["text"]), ""
        ).alias("text")
    )
    by_list = entities.groupBy("digest").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda one: one["text"]).alias(made)
    )
    between = F.split(text, ENTITY, -1)
    joined = F.array_join(
        F.flatten(F.zip_with(between, F.col(made), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), ""
    )
    by_list = by_list.withColumnRenamed("digest", digest)
    changed = marked.join(by_list, digest).withColumn(text_col, joined)
    if count_col:
        changed = changed.withColumn(count_col, F.size(F.col(found)).cast("long"))
        plain = plain.withColumn(count_col, F.lit(0).cast("long"))
        columns = [*columns, count_col] if count_col not in columns else columns
    if length_col and length_col in columns:
        kind = docs.schema[length_col].dataType
        changed = changed.withColumn(length_col, F.length(text_col).cast(kind))
    return plain.select(*columns).union(changed.select(*columns))
