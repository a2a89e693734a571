"""PII: detected entities get keyed surrogates of the same type, format and script.

Detection: one regular expression over the whole text finds e-mail and IP addresses, phone, card and
social security numbers, IBANs, hexadecimal and prefixed secrets, and names after one or more titles: any number of
capitalised parts, with hyphens, apostrophes, inner capitals, initials and particles (von, de la). Once a name is
found, its parts are replaced wherever they stand as capitalised words of the same document, with or without a title.
Other text between the matches is untouched.

Surrogates: an entity's *canonical* form (lower-cased letters and digits) and type are hashed with the key
(SHA-256); each character is replaced, by its place, with one of its class: digits by digits, vowels by
vowels and consonants by consonants of the same script (Latin plain and accented, Greek, Cyrillic; other scripts
within their block), hexadecimal by hexadecimal. Parts of IP addresses keep their length and stay valid; the
top-level domain stays. Each part of a name is an entity by itself, so a full name, a surname and a hyphenated one agree; titles,
particles and each part's last letter stay, which carry the gender. A
mention takes the surrogate's characters into its own punctuation and letter case, so all mentions of an entity agree in
every document (coreference).

Collision checks: over all distinct entities, no two of a type may share a surrogate and no surrogate may be
an entity of the corpus (nor itself). The later ones (by hash) try again with the next attempt until none collides.
Only these exceptions are a table: the others' surrogates are functions of the entity, so texts are mapped in
place, and the few documents with an exception get theirs by a join (broadcast when small).

NULL texts stay NULL, empty ones empty. Rows are mapped one by one, repeated rows each. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import column, packed, small, stable, stored

MAX_ATTEMPTS = 20
LONGER = 8
MAX_BROADCAST_ROWS = 100_000

# Titles before names, and lower-case words inside them.
TITLES = ("Mr|Mrs|Ms|Miss|Herr|Frau|Mme|Mlle|Monsieur|Madame|Sr|Sra|Señor|Señora|Dr|Doktor|Docteur|Doctor|Prof|Professor")
PARTICLES = "von|van|der|den|dem|de|la|las|los|le|du|del|della|di|da|dos|zu|zur|bin|al|y"
_PART = r"(?:\p{Lu}(?:\p{L}|['’-](?=\p{L}))+|\p{Lu}\.(?= \p{Lu}))"

_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
# (type, pattern) in the order of preference at one place.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("ip", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
    ("iban", _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END),
    ("ssn", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
    ("phone", r"(?<!\d)(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"),
    ("phone", r"(?<!\d)\+\d(?:[ .-]?\d){7,14}(?!\d)"),
    ("card", r"(?<!\d)(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19})(?!\d)"),  # whole groups
    ("card", r"(?<!\d)\d(?:[ -]?\d){12,18}(?![ -]?\d)"),
    ("secret", _EDGE + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _END),
    ("key", _EDGE + r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})" + _END),
    ("name", _EDGE + rf"(?:(?:{TITLES})\.? )+{_PART}(?: (?:(?:{PARTICLES}) ){{0,3}}{_PART})*" + _END),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
# What every match holds: a digit or @, the start of a prefixed secret, a run of hexadecimal letters, or a title.
HINTS = ("[0-9@]", r"AKIA|gh[pousr]_|sk-|[a-f]{32}|[A-F]{32}|(?:M[rsmlioa]|Herr|Frau|S[re]|Dr|Do[ck]t|Prof)\p{L}*+\.? \p{Lu}")
TITLE = rf"^(?:(?:{TITLES})\.? )+"
TOKEN = r"\p{L}+|[^\p{L}]+"  # a text in words and what is between them
CAPITAL = r"^\p{Lu}"

# The characters that may stand for one of the same class.
CLASSES = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåèéêëìíîïòóôõöùúûü", "çñß", "αεηιουω", "βγδζθκλμνξπρστφχψ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ",
)


def kind_of(mention: Column) -> Column:
    """The first type whose pattern matches the whole mention (looked at by itself)."""
    out = F.lit("name")
    for kind, pattern in reversed(PATTERNS):
        out = F.when(F.rlike(mention, F.lit(f"^(?:{pattern})$")), kind).otherwise(out)
    return out


def canonical(kind: Column, mention: Column) -> Column:
    """Lower-cased letters and digits of the mention (not a name): what its surrogate depends on. Addresses, whose parts
    matter, keep one separator between them."""
    low = F.lower(mention)
    parts = F.regexp_replace(low, r"[^\p{L}\p{N}@]+", ".")
    return F.when(kind.isin("email", "ip"), parts).otherwise(F.regexp_replace(low, r"[^\p{L}\p{N}]+", ""))


def name_parts(mention: Column) -> Column:
    """The lower-cased capitalised words of a name after its titles; initials, as in J. or O', are none."""
    found = F.regexp_extract_all(F.regexp_replace(mention, TITLE, ""), F.lit(r"\p{L}+"), F.lit(0))
    return F.transform(F.filter(found, lambda t: F.rlike(t, F.lit(CAPITAL)) & (F.char_length(t) > 1)), F.lower)


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _neighbour(c: Column, draw: Column) -> Column:
    """Another character of the same 64 code points."""
    code = F.hex(F.encode(c, "UTF-16BE"))
    low = F.conv(F.right(code, F.lit(4)), 16, 10).cast("int")
    new = low - F.pmod(low, F.lit(64)) + F.pmod(draw, F.lit(64)).cast("int")
    return F.decode(F.unhex(F.concat(F.substring(code, F.lit(1), F.length(code) - 4), F.lpad(F.hex(new), 4, "0"))), "UTF-16BE")


def _pick(chars: str, draw: Column) -> Column:
    return F.substring(F.lit(chars), F.pmod(draw, F.lit(len(chars))).cast("int") + 1, F.lit(1))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate: the same length, separators and classes. From attempt ``LONGER`` on, where
    short entities may have used up what there is, it is eight characters longer (addresses: any valid part)."""
    seed = F.sha2(F.concat_ws("\n", F.lit(key), kind, canon, attempt.cast("string")).cast("binary"), 256)
    chars = _chars(canon)
    top = F.when(kind == "email", F.char_length(F.substring_index(canon, ".", -1))).otherwise(0)
    length = F.size(chars)

    def one(c: Column, i: Column) -> Column:
        draw = F.xxhash64(seed, i)
        after = F.coalesce(F.get(chars, i + 1), F.lit("."))
        out = F.when(F.rlike(c, F.lit(r"\p{L}|\p{N}")), _neighbour(c, draw)).otherwise(c)
        for members in reversed(CLASSES):
            out = F.when(F.contains(F.lit(members), c), _pick(members, draw)).otherwise(out)
        hexa = kind == "secret"
        out = F.when(hexa, _pick("0123456789abcdef", draw)).otherwise(out)
        fixed = ~F.rlike(c, F.lit(r"\p{L}|\p{N}")) | (i >= length - top) | ((kind == "name") & (after == "."))
        return F.when(fixed, c).otherwise(out)

    tail = F.when(kind.isin("card", "phone", "ssn"), F.translate(F.substring(seed, 1, 8), "abcdef", "012345")).otherwise(
        F.translate(F.substring(seed, 1, 8), "0123456789", "bcdfghklmn"))
    plain = F.concat(F.array_join(F.transform(chars, one), ""), F.when(attempt >= LONGER, tail).otherwise(""))

    # parts of addresses: of the same length, without leading zeros, at most 255
    def octet(p: Column, i: Column) -> Column:
        draw, n = F.xxhash64(seed, i), F.char_length(p)
        low, span = F.when(n == 1, 0).when(n == 2, 10).otherwise(100), F.when(n == 1, 10).when(n == 2, 90).otherwise(156)
        return F.when(attempt >= LONGER, F.pmod(draw, F.lit(256))).otherwise(low + F.pmod(draw, span)).cast("string")

    return F.when(kind == "ip", F.array_join(F.transform(F.split(canon, "\\."), octet), ".")).otherwise(plain)


def render(kind: Column, mention: Column, canon: Column) -> Column:
    """The surrogate's letters and digits in the punctuation and letter case of the mention (or one part of a name)."""
    letters = _chars(F.regexp_replace(canon, r"[^\p{L}\p{N}]+", ""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        taken = F.get(letters, acc["k"])
        swap = F.rlike(c, F.lit(r"\p{L}|\p{N}")) & taken.isNotNull()
        cased = F.when(c != F.lower(c), F.upper(taken)).otherwise(taken)
        return F.struct(F.concat(acc["out"], F.when(swap, cased).otherwise(c)).alias("out"), (acc["k"] + F.when(swap, 1).otherwise(0)).alias("k"))

    def finish(acc: Column) -> Column:  # a lengthened surrogate has letters left
        return F.concat(acc["out"], F.array_join(F.slice(letters, acc["k"] + 1, F.size(letters)), ""))

    return F.when(kind == "ip", canon).otherwise(F.aggregate(_chars(mention), start, step, finish))


def mentions(text: Column) -> Column:
    """All matches in order. Most texts hold none of the hints, and only the others are searched."""
    hint = F.rlike(text, F.lit(HINTS[0])) | F.rlike(text, F.lit(HINTS[1]))
    return F.when(hint, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(rid, kind, canon, n): the distinct entities (parts of names each) of each row (numbered along the scan) with their mentions."""
    found = docs.select(F.monotonically_increasing_id().alias("rid"), mentions(column(text)).alias("m"))
    found = found.where(F.size("m") > 0).select("rid", F.explode("m").alias("m")).select("rid", "m", kind_of(F.col("m")).alias("kind"))
    kind, m = F.col("kind"), F.col("m")
    canons = F.when(kind == "name", name_parts(m)).otherwise(F.array(canonical(kind, m)))
    return found.select("rid", "kind", F.explode(canons).alias("canon")).groupBy("rid", "kind", "canon").agg(F.count("*").alias("n"))


def assign(distinct: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt, fake) for each distinct entity, without collisions.

    Each round settles, of all that want the same surrogate, the first by hash, unless the surrogate is an
    entity itself or settled before; the others go on. Rounds after the first hold collisions only.
    """
    open_ = distinct.select("kind", "canon", F.lit(0).alias("attempt"))
    settled = None
    for attempt in range(MAX_ATTEMPTS):
        wish = open_.withColumn("fake", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        wish = stored(wish, "pii-wishes")
        taken = distinct.select("kind", F.col("canon").alias("fake"))
        if settled is not None:
            taken = taken.union(settled.select("kind", "fake"))
        order = F.struct(F.xxhash64("canon", F.lit(key)), "canon")
        free = wish.join(taken, ["kind", "fake"], "left_anti")
        first = free.groupBy("kind", "fake").agg(F.min_by("canon", order).alias("canon")).select("kind", "canon", "fake").withColumn("attempt", F.lit(attempt))
        settled = stored(first if settled is None else settled.unionByName(first), "pii-settled")
        open_ = wish.select("kind", "canon").join(settled, ["kind", "canon"], "left_anti").withColumn("attempt", F.lit(attempt + 1))
        open_ = stored(open_, "pii-open")
        if open_.isEmpty():
            return settled
    raise RuntimeError(f"entities still collide after {MAX_ATTEMPTS} attempts")


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced; ``count`` names a column for the number of mentions."""
    docs = stable(docs)
    found = stored(entities(docs, text), "pii-entities")
    mapped = assign(stored(found.select("kind", "canon").distinct(), "pii-distinct"), key)
    odd = mapped.where("attempt > 0")
    slot = F.concat_ws("\n", "kind", "canon")
    odd_rows = (found.join(small(odd, MAX_BROADCAST_ROWS), ["kind", "canon"]).groupBy("rid")
                .agg(F.map_from_entries(F.collect_list(F.struct(slot.alias("k"), "fake"))).alias("_odd")))
    odd_rows = small(stored(odd_rows, "pii-odd"), MAX_BROADCAST_ROWS)
    rows = docs.select(packed(docs), column(text).alias("_text"), F.monotonically_increasing_id().alias("rid")).join(odd_rows, "rid", "left")
    rows = rows.select("_row", "_text", "_odd", mentions(F.col("_text")).alias("_m"))
    some = F.size("_m") > 0
    rows = rows.withColumn("_gaps", F.when(some, F.split(F.col("_text"), ANY, -1)))
    typed = F.transform("_m", lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    rows = rows.withColumn("_m", F.transform(typed, lambda x: F.struct(
        x["m"].alias("m"), x["kind"].alias("kind"), F.when(x["kind"] != "name", canonical(x["kind"], x["m"])).alias("canon"))))
    names = F.array_distinct(F.flatten(F.transform(F.filter("_m", lambda x: x["kind"] == "name"), lambda x: name_parts(x["m"]))))
    rows = rows.withColumn("_names", names)
    none = F.lit(None).cast("string")

    def fake(kind: Column, canon: Column) -> Column:
        special = F.when(F.col("_odd").isNull(), none).otherwise(F.element_at("_odd", F.concat_ws("\n", kind, canon)))
        return F.coalesce(special, surrogate(kind, canon, F.lit(0), key))

    def renamed(part: Column) -> Column:
        """A stretch of text with its capitalised words that are parts of the document's names replaced."""
        def word(t: Column) -> Column:
            mine = F.rlike(t, F.lit(CAPITAL)) & F.array_contains("_names", F.lower(t))
            return F.when(mine, render(F.lit("name"), t, fake(F.lit("name"), F.lower(t)))).otherwise(t)

        return F.array_join(F.transform(F.regexp_extract_all(part, F.lit(TOKEN), F.lit(0)), word), "")

    # a name without its titles is text with known parts, as untitled mentions are
    title = lambda x: F.when(x["kind"] == "name", F.regexp_extract(x["m"], TITLE, 0)).otherwise("")
    has_names = F.size("_names") > 0

    def plain(part: Column) -> Column:
        return F.when(has_names, renamed(part)).otherwise(part)

    def swap(x: Column, i: Column) -> Column:
        body = F.substring(x["m"], F.char_length(title(x)) + 1, F.char_length(x["m"]))
        new = F.when(x["kind"] == "name", F.concat(title(x), renamed(body))).otherwise(render(x["kind"], x["m"], fake(x["kind"], x["canon"])))
        return F.concat(new, plain(F.get(F.col("_gaps"), i + 1)))

    new = F.when(some, F.concat(plain(F.get(F.col("_gaps"), F.lit(0))), F.array_join(F.transform("_m", swap), ""))).otherwise(F.col("_text"))
    extra = [F.greatest(F.size("_m"), F.lit(0)).cast("long").alias(count)] if count else []
    kept = [new.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns if c != count]
    return rows.select(*kept, *extra)
