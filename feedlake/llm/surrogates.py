"""Personal data replaced by surrogates, in DataFrame operations only.

Every detected entity gets a replacement that depends on a secret key, its kind
and its canonical form, so the same entity has the same surrogate in all
documents. A surrogate has the type and format of what it replaces: digits for
digits, letters of the same case, separators in place, valid card checksums and
address bytes, names of the same gender and script. A check over all
distinct entities makes sure that no two share a surrogate and that no surrogate
is itself an entity of the corpus; those that collide are made again. As a rule
few are, and only documents that contain one of them need to look it up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlake.plans.handoff import written

from .common import free_name
from .quality import let

# Titles that tell a gender, and given names and name syllables by script.
TITLES = {
    "m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία"),
    "": ("Dr", "Prof", "Professor", "Doctor"),
}
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Conrad", "Emil", "Felix", "Hugo", "Ivan", "Leon", "Martin", "Oscar", "Paul", "Victor"),
    ("latin", "f"): ("Ada", "Clara", "Diana", "Elena", "Flora", "Irene", "Julia", "Laura", "Nora", "Olivia", "Rosa", "Vera"),
    ("cyrillic", "m"): ("Борис", "Виктор", "Егор", "Игорь", "Олег", "Павел", "Роман", "Тарас"),
    ("cyrillic", "f"): ("Алла", "Вера", "Дарья", "Жанна", "Ирина", "Лидия", "Нина", "Тамара"),
    ("greek", "m"): ("Άρης", "Γιάννης", "Νίκος", "Πέτρος", "Σπύρος", "Τάσος"),
    ("greek", "f"): ("Άννα", "Δάφνη", "Ελένη", "Κλειώ", "Μαρία", "Ρέα"),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga ge go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo za".split(),
    "cyrillic": "ба бе бо ва ве во га ге го да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то".split(),
    "greek": "βα βε βο γα γε γο δα δε δο κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε σο τα τε το".split(),
}

# Lower-case words inside names. After a German name an article is the next phrase's, so there it needs "von" or the like before it.
PARTICLES = "von vom van zu zum zur ter ten 't de del della delle dei degli dello di da do dos du la las le les lo los el al bin ibn ben bint abu af av y фон ван де да ди дер ντε φον βαν".split()
ARTICLES = "der den dem des das het und in op".split()


def _longest_first(words: list[str]) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


# What stands between the words of a name: a line break counts, a paragraph does not.
_GAP = r"[\s   ]{1,3}"


def _names(titles: list[str], after_name: list[str]) -> str:
    """A title and all name words after it: names, initials, and particles with a name after them.

    Loops over groups are possessive: they need no memory for each turn, however long the text is.
    """
    letters = r"(?:[\p{L}\p{M}'-]|’(?=\p{Lu}))"
    joined = r"(?:(?:d|l|dell|all|al|el|as|ash|ad|an|ar|at|az|de|di|du|la|le)['’-])?"
    name = rf"{joined}\p{{Lu}}\p{{M}}*+{letters}++"
    particles = rf"(?:(?:{_ANY}){_GAP})*+"
    one = rf"(?:(?:\p{{Lu}}\.-?)++(?:{name})?|(?:Prof|Dr|St|Ste)\.{_GAP}{name}|{name}|\p{{Lu}}(?={_GAP}{particles}\p{{Lu}}))"
    later = rf"(?:(?:{_longest_first(after_name)}){_GAP}{particles})?"
    return rf"(?:{_longest_first(titles)})\.?{_GAP}{particles}{one}(?:{_GAP}{later}{one})*+"


def _spellings(titles: tuple[str, ...]) -> list[str]:
    """Also in capitals, but for those that are other words then."""
    return [*titles, *(t.upper() for t in titles if t not in ("Ms", "Sr"))]


_GERMAN = _spellings(("Herr", "Herrn", "Frau"))
_ANY = _longest_first([*PARTICLES, *ARTICLES])
_TITLE = _longest_first([t for names in TITLES.values() for t in _spellings(names)])
_OTHERS = [t for names in TITLES.values() for t in _spellings(names) if t not in _GERMAN]
_PERSON = rf"(?<!\p{{L}})(?:{_names(_GERMAN, PARTICLES)}|{_names(_OTHERS, PARTICLES + ['der', 'den', 'das', 'het'])})"
_SECRET = r"(?:[Pp]assword|[Pp]asswd|[Pp]wd|[Ss]ecret|[Tt]oken|[Aa]pi_?[Kk]ey|PASSWORD|SECRET|TOKEN|API_KEY)\s{0,3}[=:]\s{0,3}[\"']?"
_HEX = "[0-9A-Fa-f]{1,4}"
#: What is looked for, in this order; the first kind that matches at a place counts. A domain has 127 labels at most.
PATTERNS = {
    "secret": rf"(?<![\p{{L}}\p{{N}}]){_SECRET}[^\s\"',;]{{4,}}",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-][\p{L}\p{N}._%+'-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,126}\.\p{L}{2,}",
    "access_key": r"(?<![\p{L}\p{N}])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,})(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![\p{N}]|\.[0-9])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}}|{_HEX}:(?::{_HEX}){{2,6}})(?![\p{{L}}\p{{N}}:])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\p{N})"
    r"|(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?!\p{N})",
    "card": r"(?<!\p{N})[0-9](?:[ -]?[0-9]){12,18}(?!\p{N})",
    "person": _PERSON,
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without any of these have no entity; they are most, and are not searched further.
_HINT = rf"[0-9@=:]|A[KS]IA|gh[pousr]_|sk-|(?:{_TITLE})\.?{_GAP}"
#: Up to this attempt a surrogate is a random text of its format; where a format has no more than
#: ``SMALL`` texts, those that still collide then get one that is free.
RANDOM = 8
SMALL = 1 << 20
ALPHANUMERIC = ("card", "phone", "ssn", "iban")


def kind_of(entity: Column) -> Column:
    """The kind of one entity."""
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(entity.rlike(rf"^(?:{pattern})$"), kind).otherwise(found)
    return found


def canonical_of(entity: Column, kind: Column) -> Column:
    """What is the same for all spellings of an entity: case of mail addresses, separators of numbers, the marker of a secret."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin(*ALPHANUMERIC), F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
        .when(kind == "secret", F.regexp_replace(entity, f"^{_SECRET}", ""))
        .when(kind == "ipv6", F.lower(entity))
        .when(kind == "person", F.regexp_replace(entity, _GAP, " "))
        .otherwise(entity)
    )


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 512)


def _number(stream: Column, at: Column, below: int, digits: int = 4) -> Column:
    return (F.conv(F.substr(stream, at, F.lit(digits)), 16, 10).cast("int") % below).cast("int")


def _stream(length: Column, *parts: Column) -> Column:
    """Hexadecimal digits that the key, the parts and nothing else decide; four for each of ``length`` characters."""
    blocks = F.sequence(F.lit(0), F.ceil(length / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda i: _digest(*parts, i.cast("string"))), "")


def _reshaped(value: Column, *parts: Column) -> Column:
    """Letters and digits replaced, each by one of its sort; everything else stays."""
    hexadecimal = value.rlike("^(?:[0-9a-f:]*|[0-9A-F]*)$")

    def each(stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            at = i * 4 + 1

            def pick(letters: str) -> Column:
                return F.substr(F.lit(letters), _number(stream, at, len(letters)) + 1, F.lit(1))

            return (
                F.when(c.rlike(r"^\p{N}$"), pick("0123456789"))
                .when(c.rlike(r"^\p{Lu}$"), F.when(hexadecimal, pick("ABCDEF")).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
                .when(c.rlike(r"^\p{L}$"), F.when(hexadecimal, pick("abcdef")).otherwise(pick("abcdefghijklmnopqrstuvwxyz")))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(value, ""), one), "")

    return let(_stream(F.length(value), *parts), each)


def _luhn_sum(digits: Column, last_counts_double: bool) -> Column:
    """Sum of a number's digits with every second one, from the right, doubled."""
    right = F.reverse(F.split(digits, ""))
    double = 0 if last_counts_double else 1
    worth = F.transform(
        right,
        lambda d, i: F.when(i % 2 == double, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)).otherwise(d.cast("int")).cast("int"),
    )
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x)


def _card(value: Column, *parts: Column) -> Column:
    """The first digit stays; the checksum is right exactly if it was."""
    body = F.concat(F.substr(value, F.lit(1), F.lit(1)), _reshaped(F.substr(value, F.lit(2), F.length(value) - 2), *parts))
    valid = _luhn_sum(value, False) % 10 == 0
    check = (10 - _luhn_sum(body, True) % 10) % 10
    wrong = let(_digest(*parts, F.lit("check")), lambda s: (check + 1 + _number(s, F.lit(1), 9)) % 10)
    return F.concat(body, F.when(valid, check).otherwise(wrong).cast("int").cast("string"))


def _mod97(text: Column) -> Column:
    """The number that a text of digits and capitals spells, letters as 10 to 35, modulo 97."""

    def fold(rest: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return ((rest * F.when(number > 9, 100).otherwise(10) + number) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), fold)


def _iban(value: Column, *parts: Column) -> Column:
    """The country stays; the check digits are right exactly if they were."""
    country, account = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5), F.length(value))
    valid = _mod97(F.concat(account, F.substr(value, F.lit(1), F.lit(4)))) == 1

    # of the numbers 1 to 97 only 98 less the rest, which is 1 to 97 too, is right
    off = F.when(valid, 0).otherwise(1 + _number(_digest(*parts, F.lit("check")), F.lit(1), 90))

    def checked(made: Column) -> Column:
        check = (97 - _mod97(F.concat(made, country, F.lit("00"))) + off) % 97 + 1
        return F.concat(country, F.lpad(check.cast("int").cast("string"), 2, "0"), made)

    return let(_reshaped(account, *parts), checked)


def _ip(value: Column, *parts: Column) -> Column:
    return let(
        _digest(*parts),
        lambda s: F.array_join(
            F.transform(F.split(value, r"\."), lambda o, i: (_number(s, i * 4 + 1, 254) + 1).cast("string")), "."
        ),
    )


def _domain(value: Column, key: Column) -> Column:
    """The surrogate of an address's domain, which depends on the domain alone; its last part stays."""
    domain = F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    return F.concat(_reshaped(host, key, F.lit("domain"), domain), F.lit("."), top)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _person(value: Column, key: Column, attempt: Column) -> Column:
    """Title and particles kept; given names of the same gender and script, initials for initials; family name of syllables, by the family name alone.

    The last word is the family name, all others that are no particles are given names.
    """
    return let(F.split(value, " "), lambda parts: _person_of(parts, key, attempt))


def _person_of(parts: Column, key: Column, attempt: Column) -> Column:
    title = parts[0]
    called = F.upper(F.regexp_replace(title, r"\.$", ""))
    gender = F.when(called.isin(*(t.upper() for t in TITLES["f"])), "f").when(called.isin(*(t.upper() for t in TITLES["m"])), "m").otherwise("")
    family, middle = F.element_at(parts, -1), F.slice(parts, 2, F.size(parts) - 2)
    particle = f"^(?:{_ANY})$"
    given = F.array_join(F.filter(middle, lambda w: ~w.rlike(particle)), " ")

    def of_script(word: Column, lists: dict) -> Column:
        found = F.lit(None).cast("array<string>")
        for script, known in lists.items():
            found = F.when(_script(word) == script, F.split(F.lit(" ".join(known)), " ")).otherwise(found)
        return found

    def pick(word: Column) -> Column:
        men, women = ({script: known for (script, g), known in GIVEN.items() if g == x} for x in "mf")
        both = {script: men[script] + women[script] for script in men}
        names = F.when(gender == "f", of_script(word, women)).when(gender == "m", of_script(word, men)).otherwise(of_script(word, both))
        number = _number(_digest(key, F.lit("given"), F.lower(word)), F.lit(1), 1 << 16)
        return let(names, lambda n: spelt_like(word, F.element_at(n, (number % F.size(n)).cast("int") + 1)))

    def spelt_like(word: Column, made: Column) -> Column:
        return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(made)).otherwise(made)

    def syllables(word: Column, tries: Column, count: Column) -> Column:
        both = F.struct(_stream(F.lit(32), key, F.lit("syllables"), F.lower(word), tries).alias("s"), of_script(word, SYLLABLES).alias("l"))

        def chosen(b: Column) -> Column:
            each = F.sequence(F.lit(1), count.cast("int"))
            return F.transform(each, lambda i: F.element_at(b["l"], (_number(b["s"], i * 4, 1 << 16) % F.size(b["l"])).cast("int") + 1))

        return spelt_like(word, F.initcap(F.array_join(let(both, chosen), "")))

    def replaced(word: Column) -> Column:
        letter = F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _number(_digest(key, F.lit("initial"), word), F.lit(1), 26) + 1, F.lit(1))
        return (
            F.when(word.rlike(particle), word)
            .when(word.rlike(r"^(?:\p{Lu}|(?:\p{Lu}\.-?)++)$"), F.concat(letter, F.when(word.endswith("."), ".").otherwise("")))
            .otherwise(pick(word))
        )

    tries = attempt.cast("int")
    # more people of one family than given names: the later ones get a second one after the first, the family stays
    second = F.when(tries > 0, F.concat(F.lit("-"), syllables(given, attempt, F.lit(3)))).otherwise("")
    longer = F.array_position(F.transform(middle, lambda w: w.rlike(particle)), F.lit(False))
    made = F.transform(middle, lambda w, i: F.concat(replaced(w), F.when(i + 1 == longer, second).otherwise("")))
    again = F.when(given == "", attempt).otherwise("0")
    size = F.when(given == "", 3 + F.floor(tries / RANDOM)).otherwise(3)
    return F.array_join(F.concat(F.array(title), made, F.array(syllables(family, again, size))), " ")


def _format(kind: Column, canonical: Column) -> Column:
    """The part of an entity that is numbered, with ``0``, ``A`` and ``a`` for its digits and letters; empty if its kind is not."""
    part = F.when(kind == "email", F.substring_index(canonical, "@", 1)).when(kind.isin("secret", "ssn"), canonical).otherwise("")
    plain = F.regexp_replace(F.regexp_replace(part, r"\p{N}", "0"), r"\p{Lu}", "A")
    return F.regexp_replace(plain, r"[\p{L}&&[^A]]", "a")


def _choices(c: Column) -> Column:
    return F.when(c == "0", 10).when(c.isin("A", "a"), 26).otherwise(1)


def _space(shape: Column) -> Column:
    """How many texts a format has; more than ``SMALL`` count as one more. 0 for the empty format."""
    size = F.aggregate(F.split(shape, ""), F.lit(1).cast("long"), lambda n, c: F.least(n * _choices(c), F.lit(SMALL + 1).cast("long")))
    return F.when(shape == "", F.lit(0).cast("long")).otherwise(size)


def _numbered(shape: Column, number: Column) -> Column:
    """The text of this number, from 0 on, among all of a format."""
    state = F.struct(number.cast("long").alias("rest"), F.lit("").alias("text"))

    def put(a: Column, c: Column) -> Column:
        at = (a["rest"] % _choices(c)).cast("int")
        signs = F.when(c == "0", "0123456789").when(c == "A", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").otherwise("abcdefghijklmnopqrstuvwxyz")
        sign = F.when(_choices(c) > 1, F.substr(signs, at + 1, F.lit(1))).otherwise(c)
        return F.struct(F.floor(a["rest"] / _choices(c)).alias("rest"), F.concat(sign, a["text"]).alias("text"))

    return F.aggregate(F.reverse(F.split(shape, "")), state, put, lambda a: a["text"])


def surrogate_of(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form at an attempt.

    In small formats the attempts from ``RANDOM`` on are the format's texts in
    turn; those after the last one, which only a full format needs, grow.
    """
    shape = _format(kind, canonical)
    both = F.struct(shape.alias("shape"), _space(shape).alias("space"))
    return let(both, lambda b: _surrogate(kind, canonical, attempt, key, b["shape"], b["space"]))


def _surrogate(kind: Column, canonical: Column, attempt: Column, key: str, shape: Column, space: Column) -> Column:
    secret, number = F.lit(key), attempt.cast("long") - RANDOM
    attempt = attempt.cast("string")
    told = (secret, kind, canonical, attempt)
    over = F.greatest(number - space, F.lit(-1))
    in_turn = F.concat(_numbered(shape, F.when(over < 0, number).otherwise(0)), F.when(over >= 0, over.cast("string")).otherwise(""))
    plain = _reshaped(F.when(kind == "email", F.substring_index(canonical, "@", 1)).otherwise(canonical), *told)
    text = F.when((space > 0) & (space <= SMALL) & (number >= 0), in_turn).otherwise(plain)

    def made(t: Column) -> Column:
        kept = F.when(kind == "access_key", 4).when(kind == "phone", 1).otherwise(0)
        same = F.concat(F.substr(canonical, F.lit(1), kept), F.substr(t, kept + 1, F.length(t)))
        return F.when(kind == "email", F.concat(t, F.lit("@"), _domain(canonical, secret))).otherwise(same)

    return (
        F.when(kind == "ip", _ip(canonical, *told))
        .when(kind == "card", _card(canonical, *told))
        .when(kind == "person", _person(canonical, secret, attempt))
        .when(kind == "iban", _iban(canonical, *told))
        .otherwise(let(text, made))
    )


def _laid_out(entity: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of the entity: its separators, capitals, or marker."""
    spelled = F.array_join(
        F.transform(
            F.split(entity, ""),
            lambda c, i: F.when(
                c.rlike("[0-9A-Za-z]"),
                F.substr(surrogate, F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), "[^0-9A-Za-z]", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    used = F.length(F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
    gaps = F.concat(F.regexp_extract_all(entity, F.lit(_GAP), F.lit(0)), F.array(F.lit("")))
    names = F.array_join(F.zip_with(F.split(surrogate, " "), gaps, lambda word, gap: F.concat(word, F.coalesce(gap, F.lit("")))), "")
    return (
        F.when(kind.isin(*ALPHANUMERIC), F.concat(spelled, F.substr(surrogate, used + 1, F.length(surrogate))))
        .when((kind == "email") & (entity == F.upper(entity)), F.upper(surrogate))
        .when(kind == "secret", F.concat(F.regexp_extract(entity, f"^{_SECRET}", 0), surrogate))
        .when((kind == "ipv6") & (entity == F.upper(entity)), F.upper(surrogate))
        .when(kind == "person", names)
        .otherwise(surrogate)
    )


def detect(text: Column) -> Column:
    """The entities of a text in order: an array of ``entity, kind, canonical``."""
    found = F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def told(e: Column) -> Column:
        return let(kind_of(e), lambda k: F.struct(e.alias("entity"), k.alias("kind"), canonical_of(e, k).alias("canonical")))

    return F.transform(found, told)


def resolved(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, attempt, surrogate`` of distinct entities, without collisions.

    An entity whose surrogate another one holds, or is an entity itself, tries
    again; who holds a surrogate already keeps it, else the smallest canonical
    form. Rounds go on until none collides. In formats with few texts the
    entities that collide too often share out those that are still free.
    """
    known = written(entities.select("kind", "canonical").distinct())
    state = known.select("kind", "canonical", F.lit(0).cast("long").alias("attempt"), F.lit(False).alias("held"))
    real = known.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("real"))
    made = surrogate_of(F.col("kind"), F.col("canonical"), F.col("attempt"), key)
    turn = 0
    while True:
        named = state.withColumn("surrogate", made)
        first = Window.partitionBy("kind", "surrogate").orderBy(F.desc("held"), "canonical")
        named = named.withColumn("rank", F.row_number().over(first))
        named = named.join(real, ["kind", "surrogate"], "left")
        named = written(named.withColumn("free", (F.col("rank") == 1) & F.col("real").isNull()).drop("rank", "real"))
        if not named.where("NOT free").limit(1).count():
            return named.select("kind", "canonical", "attempt", "surrogate")
        turn += 1
        state = named.select("kind", "canonical", (F.col("attempt") + F.when(F.col("free"), 0).otherwise(1)).alias("attempt"), F.col("free").alias("held"))
        if turn == RANDOM:
            state = written(_shared_out(named, real, key).unionByName(state.where("held")))


def _shared_out(named: DataFrame, real: DataFrame, key: str) -> DataFrame:
    """New attempts for the entities that are not free: the free texts of their format by a keyed order, one each."""
    shape = _format(F.col("kind"), F.col("canonical"))
    domain = F.when(F.col("kind") == "email", F.substring_index("surrogate", "@", -1)).otherwise("")
    left = named.where("NOT free").select("kind", "canonical", "attempt", shape.alias("shape"), domain.alias("domain"))
    left = written(left.withColumn("space", _space(F.col("shape"))))
    small = (F.col("space") > 0) & (F.col("space") <= SMALL)
    group = ["kind", "shape", "domain"]
    numbers = left.where(small).select(*group, "space").distinct()
    numbers = numbers.select(*group, F.explode(F.sequence(F.lit(0).cast("long"), F.col("space") - 1)).alias("number"))
    text = _numbered(F.col("shape"), F.col("number"))
    text = F.when(F.col("kind") == "email", F.concat_ws("@", text, "domain")).otherwise(text)
    used = named.where("free").select("kind", "surrogate").unionByName(real.select("kind", "surrogate"))
    numbers = numbers.withColumn("surrogate", text).join(used, ["kind", "surrogate"], "left_anti")

    def place(*parts: Column) -> Column:
        return F.row_number().over(Window.partitionBy(*group).orderBy(_digest(F.lit(key), *parts), *parts))

    numbers = numbers.select(*group, "number", place(F.col("surrogate")).alias("place"))
    counts = numbers.groupBy(*group).agg(F.count("*").alias("n"))
    waiting = left.where(small).withColumn("place", place(F.col("canonical")))
    found = waiting.join(numbers, [*group, "place"], "left").join(counts, group, "left")
    grown = F.col("space") + F.col("place") - F.coalesce("n", F.lit(0)) - 1
    attempt = RANDOM + F.coalesce("number", grown)
    found = found.select("kind", "canonical", attempt.alias("attempt"))
    again = left.where(~small).select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
    return found.unionByName(again).withColumn("held", F.lit(False))


def replace_entities(df: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``df`` with every entity in ``text_col`` replaced; other columns stay.

    ``found_col`` adds a column: an array of ``kind`` and ``surrogate`` as they
    stand in the new text. Whole texts are searched. Null texts stay null, texts
    without entities are unchanged, repeated rows are replaced alike, and an
    empty table stays empty. The same key gives the same surrogates.
    """
    e, h, x, t = (free_name(df, f"__{n}") for n in ("entities", "hash", "again", "surrogates"))
    occurrences = df.select(F.xxhash64(text_col).alias("h"), F.explode(detect(F.col(text_col))).alias("e"))
    occurrences = written(occurrences.select("h", "e.kind", "e.canonical").distinct())
    again = resolved(occurrences, key).where("attempt > 0").select("kind", "canonical", "attempt")
    again = written(again)
    rows = df.withColumn(e, detect(F.col(text_col)))
    entry = F.struct(F.concat_ws("\x1f", "kind", "canonical").alias("name"), "attempt")
    if again.limit(1).count():
        # texts with an entity that collided; the list of a text is no longer than the text
        lists = occurrences.join(again, ["kind", "canonical"]).groupBy("h").agg(F.map_from_entries(F.collect_set(entry)).alias(x))
        rows = rows.withColumn(h, F.xxhash64(text_col)).join(lists.withColumnRenamed("h", h), h, "left").drop(h)
    else:
        rows = rows.withColumn(x, F.lit(None).cast("map<string,bigint>"))

    def made(f: Column) -> Column:
        attempt = F.coalesce(F.col(x)[F.concat_ws("\x1f", f["kind"], f["canonical"])], F.lit(0))
        return _laid_out(f["entity"], f["kind"], surrogate_of(f["kind"], f["canonical"], attempt, key))

    rows = rows.withColumn(t, F.transform(e, made))
    pieces = F.zip_with(F.split(text_col, ENTITY), t, lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    text = F.when(F.size(t) > 0, F.array_join(pieces, "")).otherwise(F.col(text_col))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c != found_col]
    if found_col:
        told = F.zip_with(e, t, lambda f, s: F.struct(f["kind"].alias("kind"), s.alias("surrogate")))
        columns.append(F.coalesce(told, F.array().cast("array<struct<kind:string,surrogate:string>>")).alias(found_col))
    return rows.select(*columns)
