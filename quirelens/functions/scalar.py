"""Scalar column functions: text, paths, boxes, seeded draws.  All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANSWER_CONSTRAINTS, EXTENSION_TYPES

#: What str.strip() takes off, as far as texts have it.
WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^./]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_type(path: Column) -> Column:
    """Type by lower-cased extension; unknown ones are txt."""
    types = F.create_map(*[x for k, v in EXTENSION_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(types, extension(path)), F.lit("txt"))


def folder(path: Column, root: str) -> Column:
    """Name of the parent folder, `_root` directly under root."""
    parent = F.regexp_replace(path, r"/[^/]*$", "")
    return F.when(parent == root.rstrip("/"), F.lit("_root")).otherwise(file_name(parent))


def decoded_path(path: Column) -> Column:
    """_metadata.file_path as it is on disk: percent escapes resolved, plus signs kept, no scheme."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^file:/+", "/")


def output_path(path: Column, source: str, target: str) -> Column:
    relative = F.substring(path, len(source.rstrip("/")) + 1, 1 << 20)
    return F.concat(F.lit(target.rstrip("/")), F.regexp_replace(relative, r"(?<=[^/])\.[^./]*$", ""), F.lit(".json"))


def title(text: Column, fallback: Column, width: int = 60) -> Column:
    """First line with something on it besides number signs, at most `width` characters."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: F.substring(strip(F.ltrim(strip(x), F.lit("#"))), 1, width))
    return F.coalesce(F.get(F.filter(lines, lambda x: x != ""), F.lit(0)), fallback)


def page_estimate(text: Column, lines_per_page: int = 50) -> Column:
    return F.greatest(F.lit(1), F.floor(F.size(F.split(text, "\n")) / lines_per_page).cast("int"))


def overlap(a: Column, b: Column) -> Column:
    """Share of box a (x0, y0, x1, y1) under box b; 0 when apart or a is empty."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    area = (a[2] - a[0]) * (a[3] - a[1])
    return F.when((w > 0) & (h > 0) & (area > 0), w * h / area).otherwise(F.lit(0.0))


def polygon_box(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def sized_box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.array(x, y, x + w, y + h).cast("array<double>")


def draw(seed: int, purpose: str, *key: Column) -> Column:
    """A 60-bit number by counter: the same for the same seed, purpose and key, in any order of work."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def uniform(h: Column) -> Column:
    return h.cast("double") / F.lit(float(1 << 60))


def choose(values: Column, h: Column) -> Column:
    """Element of an array by a draw; null if it is empty."""
    return F.get(values, F.try_mod(h, F.size(values).cast("bigint")).cast("int"))


def weighted(u: Column, mix: dict[str, float]) -> Column:
    """Category of a draw in [0, 1) by cumulative weights; `answer` if they sum to nothing."""
    total = sum(mix.values())
    if total <= 0:
        return F.lit("answer")
    out, upto = None, 0.0
    for name, weight in mix.items():
        upto += weight
        out = F.when(u * total <= upto, name) if out is None else out.when(u * total <= upto, name)
    return out.otherwise(list(mix)[-1])


def constraints(behaviour: Column) -> Column:
    """struct(must_mention, must_not_mention) by expected behaviour, empty lists otherwise."""

    def lists(x: list[str]) -> Column:
        return F.array(*map(F.lit, x)).cast("array<string>")

    out = None
    for name, (yes, no) in ANSWER_CONSTRAINTS.items():
        value = F.struct(lists(yes).alias("must_mention"), lists(no).alias("must_not_mention"))
        out = F.when(behaviour == name, value) if out is None else out.when(behaviour == name, value)
    return out.otherwise(F.struct(lists([]).alias("must_mention"), lists([]).alias("must_not_mention")))


def percent(x: float) -> str:
    """For reports: rendered on the driver, where rounding is the reports' own."""
    return f"{x * 100:.1f}%"


def json_kind(description: str) -> str:
    """JSON-schema type named in a free description."""
    d = description.lower()
    return "boolean" if "bool" in d else "integer" if "int" in d else "number" if "float" in d or "num" in d else "string"


def json_field(c: Column, path: str, kind: str = "string") -> Column:
    """Value at a path of a JSON string; null where there is none or it is of another kind."""
    return F.get_json_object(c, path).try_cast(kind)
