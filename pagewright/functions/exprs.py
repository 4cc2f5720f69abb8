"""Column expressions for names, statuses, geometry and identities. All are Catalyst built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the white space that a strip of Unicode text removes
_SPACE = "\\t\\n\\x0B\\f\\r\\x1c\\x1d\\x1e\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters of an error text that a submission keeps.
ERROR_LENGTH = 500


def stripped(c: Column) -> Column:
    """Without white space at its ends, also beyond ASCII."""
    return F.regexp_replace(c, f"^[{_SPACE}]+|[{_SPACE}]+$", "")


def or_else(c: Column, other: Column) -> Column:
    """``c``, or ``other`` where it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), other)


def truthy(c: Column) -> Column:
    """1, true or yes, whatever the case and outer space."""
    return F.coalesce(F.lower(stripped(c)).isin("1", "true", "yes"), F.lit(False))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The last part of a path without its last suffix; a leading or final dot opens none."""
    return F.regexp_replace(basename(path), r"(?s)^(.+)\.[^.]+$", "$1")


def page_image_name(stored: Column, page: Column) -> Column:
    return F.concat(stem(stored), F.lit("_p"), page.cast("string"), F.lit(".jpg"))


def raw_image_name(stored: Column, page: Column) -> Column:
    return F.concat(stem(stored), F.lit("_p"), page.cast("string"), F.lit(".avif"))


def lines_name(image: Column) -> Column:
    return F.concat(basename(image), F.lit(".json"))


def joined_path(prefix: Column, rest: Column) -> Column:
    return F.concat_ws("/", F.nullif(prefix, F.lit("")), rest)


def is_pdf(extension: Column, mime: Column) -> Column:
    """By extension, or else by MIME type; null where the extension is, which fails the submission."""
    by_mime = F.lower(F.coalesce(mime, F.lit(""))) == "application/pdf"
    return F.when(extension.isNotNull(), (F.lower(extension) == ".pdf") | by_mime)


def parent_id(path: Column) -> Column:
    """The folder that holds a file, if the file lies in any."""
    parts = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def parent_path(path: Column) -> Column:
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/[^/]*$", "")


def bucket_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[a-z0-9]+://([^/]*)", 1)


def prefix_of(uri: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(uri, r"^[a-z0-9]+://[^/]*/(.*)$", 1), "/+$", "")


def fingerprint(email: Column, salt: str) -> Column:
    """SHA-256 of the salt and the stripped lower-case address; null where there is no address at all."""
    return F.when(email != "", F.sha2(F.concat(F.lit(salt), F.lower(stripped(email))), 256))


def error_text(errors: Column) -> Column:
    return F.substring(F.array_join(errors, "; "), 1, ERROR_LENGTH)


def quarter_turn(angle: Column) -> Column:
    """The clockwise right angle that undoes ``angle``; ties go to the even quarter."""
    return F.pmod(-F.rint(angle / 90) * 90, F.lit(360)).cast("int")


def reported_angle(text: Column) -> Column:
    """The angle that an orientation report names in its first line ``Rotate: n``."""
    return F.regexp_extract(text, r"(?im)^rotate:\s*(-?\d+)", 1).try_cast("int")


def resized(width: Column, height: Column, most: int) -> Column:
    """Width and height with the longer side at most ``most``; halves round to even. A side may come out as 0, which fails the page."""
    w, h = width.cast("double"), height.cast("double")
    fits = (width <= most) & (height <= most)
    wide = width > height
    new_w = F.when(fits, width).when(wide, F.lit(most)).otherwise(F.rint(w * most / h)).cast("int")
    new_h = F.when(fits, height).when(wide, F.rint(h * most / w)).otherwise(F.lit(most)).cast("int")
    return F.struct(new_w.alias("width"), new_h.alias("height"))


def raw_size(width: Column, height: Column, rotation: Column) -> Column:
    """A quarter turn swaps the sides of a raw image."""
    turned = F.coalesce(rotation.isin(90, 270), F.lit(False))
    return F.struct(F.when(turned, height).otherwise(width).alias("width"), F.when(turned, width).otherwise(height).alias("height"))


def cached_rotation(applied: Column) -> Column:
    """Rotation of the first cached transform (a map of names to JSON texts) that has the name rotation, be it null."""
    return F.get(F.filter(applied, lambda t: F.map_contains_key(t, "rotation")), F.lit(0))["rotation"].try_cast("int")


def corners(bbox: Column) -> Column:
    """The corner points of (x0, y0, x1, y1), clockwise; [] if it has not four numbers."""
    x0, y0, x1, y1 = (F.get(bbox, F.lit(k)) for k in range(4))
    four = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1))
    return F.when(F.size(bbox) == 4, four).otherwise(F.array().cast("array<array<double>>"))


def four_points(polygon: Column) -> Column:
    return F.when(F.size(polygon) == 4, polygon).otherwise(F.array().cast("array<array<double>>"))


def scaled(numbers: Column, sx: Column, sy: Column) -> Column:
    """Alternating x and y of a flat array, scaled."""
    return F.transform(numbers, lambda v, i: F.when(i % 2 == 0, v * sx).otherwise(v * sy))


def scaled_points(points: Column, sx: Column, sy: Column) -> Column:
    return F.transform(points, lambda p: F.array(p[0] * sx, p[1] * sy))


def in_box(bbox: Column, x: Column, y: Column) -> Column:
    """Inclusive at all edges."""
    return (x >= bbox[0]) & (x <= bbox[2]) & (y >= bbox[1]) & (y <= bbox[3])


def first_hit(boxes: Column, x: Column, y: Column) -> Column:
    """Index of the first of an array of boxes that holds the point; -1 if none does."""
    hits = F.transform(boxes, lambda b: in_box(b, x, y))
    return (F.array_position(hits, F.lit(True)) - 1).cast("int")


def in_polygon(points: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over the edges of an array of points."""
    n = F.size(points)

    def crosses(p: Column, i: Column) -> Column:
        q = F.element_at(points, F.when(i == 0, n).otherwise(i).cast("int"))
        spans = (p[1] > y) != (q[1] > y)
        return F.when(spans & (x < (q[0] - p[0]) * (y - p[1]) / F.nullif(q[1] - p[1], F.lit(0.0)) + p[0]), 1).otherwise(0)

    return F.aggregate(F.transform(points, crosses), F.lit(0), lambda a, v: a + v) % 2 == 1


def zoomed(zoom: Column, factor: float) -> Column:
    return F.greatest(F.lit(0.1), F.least(F.lit(10.0), zoom * factor))


def fitted(width: Column, height: Column, room_width: Column, room_height: Column) -> Column:
    """The zoom at which an image lies wholly in a room."""
    return F.greatest(F.lit(0.1), F.least(F.lit(10.0), room_width / width, room_height / height))


def fitted_width(width: Column, room_width: Column) -> Column:
    """The zoom at which an image is as wide as a room."""
    return F.greatest(F.lit(0.1), F.least(F.lit(10.0), room_width / width))


def nudged(text: Column, blank: Column, by_text: float, by_blank: float) -> Column:
    """Thresholds moved within 0 to 1, as a struct; unchanged unless the one for text stays above the one for blank."""
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), text + by_text))
    b = F.least(F.lit(1.0), F.greatest(F.lit(0.0), blank + by_blank))
    return F.when(t > b, F.struct(t.alias("text"), b.alias("blank"))).otherwise(F.struct(text.alias("text"), blank.alias("blank")))


def short_id(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 8), F.lit("..."))


def box_text(bbox: Column) -> Column:
    """[x0, y0, x1, y1] in whole pixels, halves to even, zeros with their sign; '' without four numbers, null if one is null."""

    def whole(v: Column) -> Column:
        v = F.rint(v)
        sign = F.when(v.cast("string").startswith("-"), "-").otherwise("")
        beyond = F.replace(F.lower(F.format_string("%.0f", v)), F.lit("infinity"), F.lit("inf"))
        return F.when(v.isNotNull(), F.when(F.abs(v) < float(1 << 63), F.concat(sign, F.abs(v).cast("long").cast("string"))).otherwise(beyond))

    x0, y0, x1, y1 = (whole(F.get(bbox, F.lit(k))) for k in range(4))
    return F.when(F.size(bbox) == 4, F.concat(F.lit("["), x0, F.lit(", "), y0, F.lit(", "), x1, F.lit(", "), y1, F.lit("]"))).otherwise("")


def confidence_text(confidence: Column) -> Column:
    """Three decimals, halves of the shortest decimal text to even; nothing known counts as 0."""
    return F.format_string("%.3f", F.bround(F.coalesce(confidence, F.lit(0.0)), 3))


def image_format(extension: Column) -> Column:
    """The encoder's name for a file extension, with or without its dot: JPEG for jpg and for none."""
    name = F.upper(F.ltrim(F.coalesce(extension, F.lit("")), F.lit(".")))
    return F.when(name.isin("", "JPG"), "JPEG").otherwise(name)


def thumbnail(points: Column, width: Column, height: Column, to_width: Column, to_height: Column) -> Column:
    """Points of an image in a thumbnail of it; null where the image has no size."""
    return scaled_points(points, to_width / F.nullif(width, F.lit(0)), to_height / F.nullif(height, F.lit(0)))
