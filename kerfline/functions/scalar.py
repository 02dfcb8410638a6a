"""Scalar functions over columns: quantising, comparing, normalising, plane geometry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quantize(value: Column, tolerance: float) -> Column:
    """Half-even multiple of the tolerance; not finite numbers as they are; raw if the tolerance isn't positive."""
    if tolerance <= 0:
        return value
    return F.when(finite(value).isNull(), value).otherwise(F.rint(value / F.lit(tolerance)))


def quantize_as(value: Column, kind: T.DataType, tolerance: float) -> Column:
    """quantize for a value of any type: numbers inside arrays, structs and maps too; maps as entries by key; other values as they are."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: quantize_as(x, kind.elementType, tolerance))
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*[quantize_as(value[f.name], f.dataType, tolerance).alias(f.name) for f in fields]))
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), quantize_as(e["value"], kind.valueType, tolerance).alias("value"))))
    if isinstance(kind, T.NumericType):
        return quantize(value.cast("double"), tolerance)
    return value


def quantize_text(value: Column, tolerance: float) -> Column:
    """As text; null, NaN and infinite values all are 'non_finite'. Multiples beyond 64 bits are written as doubles."""
    n = F.rint(finite(value) / F.lit(tolerance))
    return F.coalesce(n.try_cast("bigint").cast("string"), n.cast("string"), F.lit("non_finite"))


def finite(value: Column) -> Column:
    """The value, or null if it isn't a finite number."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def finite_or_zero(value: Column) -> Column:
    return F.coalesce(finite(value), F.lit(0.0))


def nearly_equal(left: Column, right: Column, relative: float = 1e-12) -> Column:
    return F.abs(left - right) <= F.lit(relative) * F.greatest(F.lit(1.0), F.abs(left), F.abs(right))


def significant(value: Column, digits: int = 4) -> Column:
    """Rounded half-even to so many significant digits; tiny values are 0."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - (digits - 1))
    return F.when(F.abs(value) < 1e-9, F.lit(0.0)).otherwise(F.rint(value / unit) * unit)


def significant_text(value: Column) -> Column:
    """Four significant digits, as text with up to four decimals and no zeros at the end; null stays null."""
    text = F.format_string("%.4f", significant(value.cast("double")))
    return F.when(value.isNotNull(), F.regexp_replace(F.regexp_replace(text, "0+$", ""), "\\.$", ""))


def bound(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def general_text(value: Column) -> Column:
    """A number that is not negative as text with up to six significant digits and no zeros at the end; from a million on, and under a ten-thousandth, with an exponent."""

    def rounded(v: Column) -> Column:
        digits = F.bround(v["value"] / F.pow(F.lit(10.0), v["exponent"]), 5)  # may come out as 10
        return F.struct(digits.alias("digits"), v["exponent"].alias("exponent"))

    def carried(v: Column) -> Column:
        over = v["digits"] >= 10
        return F.struct(F.when(over, v["digits"] / 10).otherwise(v["digits"]).alias("digits"), F.when(over, v["exponent"] + 1).otherwise(v["exponent"]).alias("exponent"))

    def written(v: Column) -> Column:
        digits, exponent = v["digits"], v["exponent"]
        strip = lambda text: F.regexp_replace(F.regexp_replace(text, "0+$", ""), "\\.$", "")  # noqa: E731  they all have a point
        plain = strip(F.format_string("%.9f", F.bround(digits * F.pow(F.lit(10.0), exponent), 9)))
        sign = F.when(exponent < 0, "e-").otherwise("e+")
        return F.when((exponent >= 6) | (exponent < -4), F.concat(strip(F.format_string("%.5f", digits)), sign, F.lpad(F.abs(exponent).cast("string"), 2, "0"))).otherwise(plain)

    start = F.struct(value.alias("value"), F.floor(F.log10(F.when(value > 0, value).otherwise(1.0))).cast("int").alias("exponent"))
    return bound(start, lambda v: bound(rounded(v), lambda r: bound(carried(r), written)))


def value_text(value: Column, kind: T.DataType) -> Column:
    """A value of that type as text without regard to language: null is empty, doubles have up to 15 significant digits.

    From 1e15 on, and under a ten-thousandth, doubles are written with an exponent of two
    digits or more. The digits are those of the shortest text that reads back as the double.
    """
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False").otherwise("")
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(value.cast("string"), F.lit(""))
    dotted = lambda whole, rest: F.when(rest == "", whole).otherwise(F.concat(whole, F.lit("."), rest))

    def taken_apart(parts: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(F.get(parts, F.lit(0)), "\\.", ""), "0+$", "")
        return F.struct(digits.alias("digits"), F.get(parts, F.lit(1)).cast("int").alias("power"))

    def written(v: Column) -> Column:
        digits, power = F.when(v["digits"] == "", "0").otherwise(v["digits"]), v["power"]
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        plain = F.when(power < 0, small).when(F.length(digits) <= power + 1, F.rpad(digits, power + 1, "0")).otherwise(dotted(F.substr(digits, F.lit(1), power + 1), F.substr(digits, power + 2)))
        long = F.concat(dotted(F.substr(digits, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2))), F.when(power < 0, "E-").otherwise("E+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
        return F.when((power >= 15) | (power < -4), long).otherwise(plain)

    def text(v: Column) -> Column:
        shown = bound(F.split(F.format_string("%.14e", F.abs(v).cast("double")), "e"), lambda parts: bound(taken_apart(parts), written))
        special = F.when(F.isnan(v), "NaN").when(F.abs(v) == float("inf"), F.when(v > 0, "Infinity").otherwise("-Infinity"))
        return F.when(v.isNull(), "").when(special.isNotNull(), special).otherwise(F.concat(F.when(v < 0, "-").otherwise(""), shown))

    return bound(value, text)


def json_text(text: Column) -> Column:
    """A text as it stands between the quotes of an export document: backslash, quote, carriage return, line feed and tab are escaped, no others; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def number(text: Column) -> Column:
    """The number that a text spells, 'nan' and 'inf' among them; null for others."""
    return F.trim(text.cast("string")).try_cast("double")


def clean(text: Column) -> Column:
    """Without white space at the ends; null is empty."""
    return F.trim(F.coalesce(text.cast("string"), F.lit("")))


CONFIRMED = "已确认"  # fixed value: the status of a confirmed quantity


def confirmed(quantity: Column) -> Column:
    """The number of an evidence struct (value_mm, status, ..) where its status is confirmed, else null."""
    return F.when(clean(quantity["status"]) == CONFIRMED, quantity["value_mm"].try_cast("double"))


def handle_text(handle: Column) -> Column:
    """A numeric handle in upper-case hexadecimal; zero and null are empty."""
    return F.when(F.coalesce(handle, F.lit(0)) == 0, F.lit("")).otherwise(F.hex(handle))


# fixed values: what notifications begin with, and the group that they are counted in
MESSAGES = (("Entity in SortEntitiesTable ", "Entity in SortEntitiesTable not found"), ("Entry not found ", "Dictionary entry not found"))
UNLISTED = ("Unlisted object with DXF name ", " has been")


def message_group(message: Column) -> Column:
    """What a notification is counted as: the part that does not name one object."""
    start, stop = UNLISTED
    out = F.when(message.startswith(start), F.substring_index(message, stop, 1))
    for begin, group in MESSAGES:
        out = out.when(message.startswith(begin), F.lit(group))
    return out.otherwise(message)


def first_known(*cases: tuple[Column, Column]) -> Column:
    """The value of the first case whose condition holds and whose value is known."""
    return F.coalesce(*[F.when(condition, value) for condition, value in cases])


#: fixed values: class names of records and the type that they are compared as
TYPE_NAMES = {"DBText": "TEXT", "MText": "MTEXT", "AttributeDefinition": "ATTDEF", "AttributeReference": "ATTRIB", "BlockReference": "INSERT"}


def type_name(kind: Column, names: dict[str, str] = TYPE_NAMES) -> Column:
    """The common name of a record's class; others in upper case."""
    out = None
    for k, v in names.items():
        out = F.when(kind == k, v) if out is None else out.when(kind == k, v)
    return out.otherwise(F.upper(kind))


def paper_viewport(flag: Column, number_: Column) -> Column:
    """The flag where there is one, else whether the number is 1, else false."""
    return F.coalesce(flag, number_.try_cast("int") == 1, F.lit(False))


def finite_rules(df: DataFrame, skip: tuple[str, ...] = ()) -> list[tuple[str, Column]]:
    """A rule for each number anywhere in the schema, named by its path: broken where the number is NaN or infinite."""

    def bad(value: Column, kind: T.DataType) -> Column | None:
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.isnan(value) | (F.abs(value) == float("inf"))
        if isinstance(kind, T.ArrayType):
            return None if not _numbers(kind) else F.exists(value, lambda x: F.coalesce(bad(x, kind.elementType), F.lit(False)))
        if isinstance(kind, T.StructType):
            found = [b for f in kind.fields if (b := bad(value[f.name], f.dataType)) is not None]
            return None if not found else reduce(lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)), found)
        return None

    def walk(value: Column, kind: T.DataType, path: str):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from walk(value[f.name], f.dataType, f"{path}.{f.name}" if path else f.name)
        elif (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
            yield f"{path}[]", F.exists(value, lambda x: F.coalesce(bad(x, kind.elementType), F.lit(False))) if _numbers(kind) else F.lit(False)
        elif _numbers(kind):
            yield path, F.coalesce(bad(value, kind), F.lit(False))

    return [(f"{path} is not finite", rule) for f in df.schema.fields if f.name not in skip for path, rule in walk(F.col(f.name), f.dataType, f.name)]


def _numbers(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _numbers(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_numbers(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def safe_name(name: Column) -> Column:
    return F.translate(name, "/|", "__")


def non_blank(text: Column) -> Column:
    return F.coalesce(text.rlike("(?U)\\S"), F.lit(False))


def names(kind: Column, word: str) -> Column:
    """Whether a type's name has a word in it, in any case."""
    return F.coalesce(F.contains(F.lower(kind), F.lit(word.lower())), F.lit(False))


def selected(name: Column, effective: Column, handle: Column, name_pattern: str, handle_pattern: str | None = None) -> Column:
    """Roots to expand: the own or the effective name matches in any case, and the handle too where a pattern is given."""
    hit = name.rlike(f"(?i){name_pattern}") | effective.rlike(f"(?i){name_pattern}")
    return F.coalesce(hit & handle.rlike(f"(?i){handle_pattern}") if handle_pattern else hit, F.lit(False))


def version_number(code: Column) -> Column:
    """AC1032 -> 1032; null for other codes."""
    return F.when(code.rlike("^AC[0-9]{4}$"), F.substring(code, 3, 4).cast("int"))


def is_sha256(text: Column) -> Column:
    return text.rlike("^[0-9A-Fa-f]{64}$")


def reasons(*pairs: tuple[Column, str], default: str = "") -> Column:
    """The texts whose condition holds, in order, joined by ;"""
    text = F.concat_ws(";", *[F.when(c, F.lit(t)) for c, t in pairs])
    return F.when(text == "", F.lit(default)).otherwise(text)


def visibility_reason(parent_visible: Column, entity_visible: Column, layer: Column, inherits: Column) -> Column:
    """Why an instance is hidden in the database, all reasons in order; layer is a struct (is_off, is_frozen, is_hidden), null where it could not be read."""
    # fixed values: the reasons, and what is said without any
    return reasons(
        (~parent_visible, "hidden_parent"), (~entity_visible, "entity_visible_false"), (layer.isNull(), "effective_layer_unreadable"),
        (layer["is_off"], "effective_layer_off"), (layer["is_frozen"], "effective_layer_frozen"), (layer["is_hidden"], "effective_layer_hidden"),
        (inherits, "layer0_inherits_parent_layer"), default="visible_in_database",
    )
