"""Text forms of keys, numbers, payloads and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Twelve significant digits are taken from whole numbers of this size.
DIGITS = 10**11


def market_key(loc: Column, type_id: Column, buy: Column) -> Column:
    """`loc|type|true`, the key under which an aggregate is served."""
    return F.concat_ws("|", loc.cast("string"), type_id.cast("string"), buy.cast("string"))


def twelve_digits(value: Column) -> Column:
    """Twelve significant digits, padded with zeros. Costly: project it before `number_text`."""
    return F.when(value.isNotNull(), F.format_string("%.12g", value.cast("double")))


def number_text(digits: Column) -> Column:
    """The digits without padding zeros; a plain number keeps at least one decimal."""
    short = F.rtrim(digits, F.lit("0"))
    return (
        F.when(digits.contains("e"), F.regexp_replace(digits, r"\.?0*e", "e"))
        .when(~digits.contains("."), F.concat(digits, F.lit(".0")))
        .when(short.endswith("."), F.concat(short, F.lit("0")))
        .otherwise(short)
    )


def float_text(value: Column) -> Column:
    """A float with twelve significant digits, no padding zeros and at least one decimal."""
    return number_text(twelve_digits(value))


def with_number_texts(rows: DataFrame, *names: str) -> DataFrame:
    """Rows with the columns `names` as their `float_text`.

    The formatter is slow. Of a common number the twelve digits are a product rounded half up, unless it lies so close to a
    half that its last bits decide; only such numbers and very small or large ones are formatted. Each step is a projection
    of its own, small enough to be compiled.
    """
    powers = F.array(*[F.lit(10.0**n) for n in range(15)])
    whole_powers = F.array(*[F.lit(10**n).cast("long") for n in range(15)])
    made = lambda kind, make: {f"{kind}_{n}": make(n) for n in names}
    of = lambda kind, n: F.col(f"{kind}_{n}")
    common = lambda n: F.col(n).between(0.01, DIGITS - 1)
    steps = rows.withColumns({n: F.col(n).cast("double") for n in names})
    steps = steps.withColumns(made("places", lambda n: F.when(common(n), (11 - F.floor(F.log10(n))).cast("int"))))
    steps = steps.withColumns(made("scaled", lambda n: F.col(n) * F.get(powers, of("places", n))))
    steps = steps.withColumns(made("digits", lambda n: F.floor(of("scaled", n) + 0.5)) | made("unit", lambda n: F.get(whole_powers, of("places", n))))

    def known(n: str) -> Column:
        scaled = of("scaled", n)
        clear = F.abs(scaled - F.floor(scaled) - 0.5) > 0.001
        return F.coalesce((scaled >= DIGITS) & (scaled < 10 * DIGITS) & clear, F.lit(False))

    def plain(n: str) -> Column:
        rest = of("digits", n) % of("unit", n)
        decimals = F.rtrim(F.lpad(rest.cast("string"), of("places", n), F.lit("0")), F.lit("0"))
        whole = F.call_function("div", of("digits", n), of("unit", n)).cast("string")
        return F.concat(whole, F.lit("."), F.when(rest == 0, "0").otherwise(decimals))

    def formatted(n: str) -> Column:
        # In a lambda, so that the long way is not compiled into the short one.
        return F.get(F.transform(F.array(n), float_text), F.lit(0))

    steps = steps.withColumns(made("known", known))
    zero = lambda n: F.when(F.col(n) == 0, F.col(n).cast("string"))
    texts = {n: F.when(of("known", n), plain(n)).otherwise(F.coalesce(zero(n), formatted(n))) for n in names}
    return steps.select(*[texts[c].alias(c) if c in names else c for c in rows.columns])


def payload(*values: Column) -> Column:
    """Values joined by `|`; a missing value keeps its place as an empty text."""
    return F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in values])


def payload_field(text: Column, position: int) -> Column:
    """Field `position` (from 0) of a payload as a number; missing or empty counts as 0."""
    field = F.get(F.split(text, "[|]"), F.lit(position))
    return F.coalesce(field.try_cast("double"), F.lit(0.0))


def display_number(value: Column, decimals: int) -> Column:
    """Thousands separated by commas, rounded half up."""
    return F.format_number(F.round(value.cast("decimal(38,6)"), decimals), decimals)


def minute_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm")


def only_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def natural_key(name: Column) -> Column:
    """Sort key under which digit runs of any length compare as numbers: `s-9` before `s-10`.

    A run is its digits without leading zeros, after their count.
    """
    runs = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(run: Column) -> Column:
        digits = F.ltrim(run, F.lit("0"))
        return F.when(
            run.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)
        ).otherwise(run)

    return F.transform(runs, key)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def security_class(security: Column) -> Column:
    return F.when(security > 0.5, "high").when(security > 0, "low").otherwise("null")


def security_text(security: Column) -> Column:
    """Security with one significant digit, however small."""
    short = F.format_string("%.0e", security.cast("double")).cast("decimal(38,30)")
    return F.when(security == 0, "0").otherwise(F.regexp_replace(short.cast("string"), r"\.?0+$", ""))
