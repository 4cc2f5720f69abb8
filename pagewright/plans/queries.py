"""The operators over the driver's tables, with the same in SQL.

The tables stand in: documents are found submissions, labels their manifest
(quality 1 is completed), orders are submissions and line items their pages
(R is failed), conversations are pages with a composite key, page URLs are
paths, events a stream of results, embeddings hold the corners of boxes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import exprs as E
from pagewright.operators import relational as R
from pagewright.operators.spatial import lines_at
from pagewright.plans import consumer
from pagewright.schema import COMPLETED, FAILED, PENDING
from pagewright.sources import packs, state
from pagewright.sources.scratch import shared_folder
from pagewright.sources.storage import Storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        return f

    return add


def _found(t) -> DataFrame:
    return t("documents").select(F.col("doc_id").alias("submission_id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_path"))


def _manifest(t) -> DataFrame:
    return t("labels").select(F.col("doc_id").alias("submission_id"), F.when(F.col("quality") == 1, COMPLETED).otherwise(FAILED).alias("status"))


def _line_status() -> Column:
    return F.when(F.col("l_returnflag") == "A", COMPLETED).when(F.col("l_returnflag") == "R", FAILED).otherwise(PENDING)


def _line_pages(t) -> DataFrame:
    """Line items as pages."""
    part = F.col("l_partkey").cast("string")
    return t("lineitem").select(
        F.col("l_orderkey").alias("submission_id"),
        F.concat(part, F.lit(".pdf")).alias("doc_filename"),
        F.col("l_linenumber").alias("page_number"),
        _line_status().alias("status"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("line "), part)).otherwise("").alias("error"),
        F.when(F.col("l_linestatus") == "F", E.page_image_name(part, F.col("l_linenumber"))).otherwise("").alias("image_filename"),
    )


@_query("""SELECT doc_id AS submission_id, concat_ws('/', source, CAST(doc_id AS VARCHAR)) AS source_path FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""")
def work_queue_pending(t):
    return R.work_queue(_found(t), _manifest(t))


@_query("""SELECT d.doc_id AS submission_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS already_done FROM documents d""")
def work_queue_forced(t):
    done = _manifest(t).filter(F.col("status") == COMPLETED).select("submission_id", F.lit(True).alias("done"))
    every = R.work_queue(_found(t), _manifest(t), force=True)
    return every.join(done, "submission_id", "left").select("submission_id", F.coalesce("done", F.lit(False)).alias("already_done"))


@_query("""SELECT doc_id AS submission_id FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) ORDER BY string_split(concat_ws('/', source, CAST(doc_id AS VARCHAR)), '/'), doc_id LIMIT 25""")
def work_queue_limited(t):
    return R.first_by_path(R.work_queue(_found(t), _manifest(t)), 25).select("submission_id")


@_query("""WITH work AS (SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1))
           SELECT doc_id AS submission_id, CASE WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS status, 'carried' AS origin
           FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM work)
           UNION ALL SELECT doc_id, 'completed', 'new' FROM work""")
def carry_forward_manifest(t):
    manifest = _manifest(t)
    work = R.work_queue(_found(t), manifest)
    new = work.select("submission_id", F.lit(COMPLETED).alias("status"), F.lit("new").alias("origin"))
    return R.published(R.carried(manifest, work).withColumn("origin", F.lit("carried")), new)


@_query("""SELECT o_orderkey AS submission_id, o_orderstatus AS status, o_totalprice AS price FROM orders
           WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def carried_from_buckets(t):
    """Orders as the rows of a bucketed manifest; those with a returned line item are worked on again."""
    orders = t("orders").select(F.col("o_orderkey").alias("submission_id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    work = t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("submission_id"))
    name = f"manifest_{uuid.uuid4().hex}"
    return state.carried(state.save(orders, name, 32, f"{shared_folder(orders.sparkSession)}/{name}"), work)


@_query("""SELECT o_orderkey AS submission_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def in_flight_ids(t):
    return R.in_flight(t("orders").select(F.col("o_orderkey").alias("submission_id")), t("lineitem").select(F.col("l_orderkey").alias("submission_id")))


@_query("""WITH p AS (SELECT l_orderkey AS id, l_linenumber AS ln, CAST(l_partkey AS VARCHAR) || '.pdf' AS doc, l_returnflag = 'R' AS bad,
                            CASE WHEN l_returnflag = 'R' THEN 'line ' || CAST(l_partkey AS VARCHAR) ELSE '' END AS error,
                            CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS VARCHAR) || '_p' || CAST(l_linenumber AS VARCHAR) || '.jpg' ELSE '' END AS image FROM lineitem),
           s AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE bad) AS b,
                        string_agg(error, '; ' ORDER BY ln, doc, image, error) FILTER (WHERE bad AND error <> '') AS errors,
                        string_agg(coalesce(nullif(image, ''), doc), ', ' ORDER BY ln, doc, image, error) FILTER (WHERE bad) AS names FROM p GROUP BY id)
           SELECT o_orderkey AS submission_id, CASE WHEN n = b THEN 'failed' ELSE 'completed' END AS status,
                  CASE WHEN n = b THEN substr(coalesce(errors, ''), 1, 500) WHEN b > 0 THEN 'Some pages failed: ' || names ELSE '' END AS error
           FROM orders LEFT JOIN s ON id = o_orderkey""")
def submission_rollup(t):
    return R.roll_up(t("orders").select(F.col("o_orderkey").alias("submission_id")), _line_pages(t))


@_query("""SELECT CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'failed' ELSE 'pending' END AS status, count(*) AS n FROM lineitem GROUP BY 1""")
def run_status_counts(t):
    return R.status_counts(_line_pages(t))


@_query("""SELECT l_orderkey AS submission_id, count(*) AS pages, count(*) FILTER (WHERE l_returnflag = 'R') AS failed FROM lineitem GROUP BY 1""")
def page_counts_per_submission(t):
    return R.page_counts(_line_pages(t))


@_query("""SELECT user_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value FROM events GROUP BY 1""")
def manifest_last_wins(t):
    return R.last_wins(t("events").select("user_id", "event_type", "value", "event_id"), ("user_id",), "event_id").drop("event_id")


_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', '')"


@_query(f"""WITH p AS (SELECT page_id, {_PATH} AS path FROM pages), s AS (SELECT page_id, path, string_split(path, '/') AS parts FROM p)
           SELECT page_id, parts[len(parts) - 1] AS submission_id, regexp_replace(path, '/[^/]*$', '') AS source_path FROM s WHERE len(parts) >= 2""")
def discover_ids(t):
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^[a-z]+://", "")
    found = t("pages").select("page_id", path.alias("path"))
    return found.select("page_id", E.parent_id(F.col("path")).alias("submission_id"), E.parent_path(F.col("path")).alias("source_path")).filter("submission_id IS NOT NULL")


@_query("""SELECT page_id, regexp_extract(url, '^[a-z0-9]+://([^/]*)', 1) AS bucket,
                  regexp_replace(regexp_extract(url, '^[a-z0-9]+://[^/]*/(.*)$', 1), '/+$', '') AS prefix,
                  CASE WHEN regexp_replace(regexp_extract(url, '^[a-z0-9]+://[^/]*/(.*)$', 1), '/+$', '') = '' THEN 'pages.csv'
                       ELSE regexp_replace(regexp_extract(url, '^[a-z0-9]+://[^/]*/(.*)$', 1), '/+$', '') || '/pages.csv' END AS manifest FROM pages""")
def storage_uri_parse(t):
    url = F.col("url")
    return t("pages").select("page_id", E.bucket_of(url).alias("bucket"), E.prefix_of(url).alias("prefix"), E.joined_path(E.prefix_of(url), F.lit("pages.csv")).alias("manifest"))


@_query("""WITH s AS (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 5)
           SELECT source, count(*) AS n FROM documents WHERE source IN (SELECT source FROM s) GROUP BY 1""")
def distinct_sources_top_n(t):
    return R.first_ids(t("documents").select("source"), 5, "source").groupBy("source").agg(F.count("*").alias("n"))


@_query("""SELECT conv_id, turn FROM conversations WHERE role = 'assistant' AND text <> '' AND turn % 3 <> 0""")
def backfill_eligible(t):
    pages = t("conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", COMPLETED).otherwise(FAILED).alias("status"),
        F.col("text").alias("image_filename"),
        F.when(F.col("turn") % 3 == 0, "raw.avif").otherwise("").alias("raw_image_filename"),
    )
    return R.wants_raw_image(pages).select("conv_id", "turn")


@_query("""SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text || ' (again)' ELSE text END AS text, role FROM conversations""")
def backfill_merge(t):
    pages = t("conversations").select("conv_id", "turn", "role", "text")
    updates = pages.filter("role = 'assistant'").withColumn("text", F.concat("text", F.lit(" (again)")))
    return R.upserted(pages, updates, ("conv_id", "turn"))


@_query("""SELECT o_orderkey, o_custkey AS submission_id, c_name AS source_path, c_name IS NULL AS lost
           FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey <> 7""")
def source_path_lookup(t):
    found = t("customer").filter("c_nationkey <> 7").select(F.col("c_custkey").alias("submission_id"), F.col("c_name").alias("source_path"))
    return R.with_source_path(t("orders").select("o_orderkey", F.col("o_custkey").alias("submission_id")), found).select("o_orderkey", "submission_id", "source_path", "lost")


@_query("""SELECT l_orderkey, l_linenumber, p_type AS file_extension, count(*) AS n FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""")
def doc_lookup(t):
    pages = t("lineitem").select("l_orderkey", "l_linenumber", F.lit(0).alias("submission_id"), F.col("l_partkey").alias("doc_filename"))
    entries = t("part").select(F.lit(0).alias("submission_id"), F.col("p_partkey").alias("doc_filename"), F.col("p_type").alias("file_extension"), F.lit(0).alias("position"))
    return R.with_document(pages, entries).groupBy("l_orderkey", "l_linenumber", "file_extension").agg(F.count("*").alias("n"))


@_query("""SELECT coalesce(CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN NULL ELSE (p_size % 4) * 90 END, 0) AS rotation, count(*) AS n
           FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def cached_rotation_lookup(t):
    """The cache holds an entry without a rotation before each that has one; for some parts that is null, and for some a null comes first and counts."""
    known = F.when(F.col("p_size") % 5 != 0, ((F.col("p_size") % 4) * 90).cast("string"))
    entry = lambda c: F.create_map(F.lit("rotation"), c)
    other = F.create_map(F.lit("original_size"), F.lit("[9, 9]"))
    applied = F.when(F.col("p_size") % 7 == 0, F.array(entry(F.lit(None).cast("string")), entry(known))).otherwise(F.array(other, entry(known)))
    cache = t("part").select(F.col("p_partkey").alias("l_partkey"), applied.alias("applied"))
    rotation = F.coalesce(E.cached_rotation(F.col("applied")), F.lit(0))
    return t("lineitem").select("l_partkey").join(cache, "l_partkey").groupBy(rotation.alias("rotation")).agg(F.count("*").alias("n"))


@_query("""SELECT event_id, CAST((((-(round_even(value * 9 / 90, 0) * 90)) % 360) + 360) % 360 AS INTEGER) AS rotation FROM events""")
def rotation_normalise(t):
    return t("events").select("event_id", E.quarter_turn(F.col("value") * 9).alias("rotation"))


@_query("""WITH s AS (SELECT p_partkey, p_size * 97 AS w, (p_partkey % 50 + 1)::INTEGER * 83 AS h, (p_size % 4) * 90 AS r FROM part),
           n AS (SELECT *, w <= 1024 AND h <= 1024 AS fits FROM s)
           SELECT p_partkey, CASE WHEN fits THEN w WHEN w > h THEN 1024 ELSE CAST(round_even(w::DOUBLE * 1024 / h, 0) AS INTEGER) END AS width,
                  CASE WHEN fits THEN h WHEN w > h THEN CAST(round_even(h::DOUBLE * 1024 / w, 0) AS INTEGER) ELSE 1024 END AS height,
                  CASE WHEN r IN (90, 270) THEN h ELSE w END AS raw_width, CASE WHEN r IN (90, 270) THEN w ELSE h END AS raw_height FROM n""")
def resize_dims(t):
    w, h = F.col("p_size") * 97, ((F.col("p_partkey") % 50 + 1) * 83).cast("int")
    sized = t("part").select("p_partkey", E.resized(w, h, 1024).alias("s"), E.raw_size(w, h, (F.col("p_size") % 4) * 90).alias("r"))
    return sized.select("p_partkey", "s.width", "s.height", F.col("r.width").alias("raw_width"), F.col("r.height").alias("raw_height"))


@_query("""WITH n AS (SELECT conv_id, turn, role || '.' || conv_id || '.pdf' AS stored FROM conversations),
           s AS (SELECT *, regexp_replace(stored, '^(.+)\\.[^.]+$', '\\1', 's') AS stem FROM n)
           SELECT conv_id, turn, stem || '_p' || (turn + 1) || '.jpg' AS image, stem || '_p' || (turn + 1) || '.avif' AS raw,
                  stem || '_p' || (turn + 1) || '.jpg.json' AS lines FROM s""")
def page_artifact_names(t):
    stored, page = F.concat_ws(".", "role", F.col("conv_id").cast("string"), F.lit("pdf")), F.col("turn") + 1
    image = E.page_image_name(stored, page)
    return t("conversations").select("conv_id", "turn", image.alias("image"), E.raw_image_name(stored, page).alias("raw"), E.lines_name(image).alias("lines"))


@_query("""SELECT p_partkey, lower(CASE p_type WHEN 'SMALL' THEN '.PDF' WHEN 'LARGE' THEN '.jpg' ELSE '' END) = '.pdf'
                  OR lower(coalesce(CASE p_type WHEN 'PROMO' THEN 'Application/PDF' WHEN 'LARGE' THEN 'image/jpeg' END, '')) = 'application/pdf' AS is_pdf FROM part""")
def pdf_classification(t):
    kind = F.col("p_type")
    extension = F.when(kind == "SMALL", ".PDF").when(kind == "LARGE", ".jpg").otherwise("")
    mime = F.when(kind == "PROMO", "Application/PDF").when(kind == "LARGE", "image/jpeg")
    return t("part").select("p_partkey", E.is_pdf(extension, mime).alias("is_pdf"))


@_query("""SELECT c_custkey, sha256('pepper' || lower(trim('  ' || c_name || '@Example.COM '))) AS fingerprint FROM customer""")
def submitter_fingerprint(t):
    email = F.concat(F.lit("  "), "c_name", F.lit("@Example.COM "))
    return t("customer").select("c_custkey", E.fingerprint(email, "pepper").alias("fingerprint"))


@_query("""SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def metadata_extract(t):
    return t("events").withColumnRenamed("props", "metadata").select("event_id", consumer.field("k").alias("k"))


_CORNERS = "[embedding[1], embedding[2]], [embedding[3], embedding[4]], [embedding[5], embedding[6]], [embedding[7], embedding[8]]"


def _points() -> Column:
    """Four points from the first eight numbers of an embedding, times 1000."""
    number = lambda k: F.element_at("embedding", k).cast("double") * 1000
    return F.array(*(F.array(number(2 * k + 1), number(2 * k + 2)) for k in range(4)))


def _box(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


@_query("""SELECT vec_id, (unnest(range(4)))::INTEGER AS index, unnest([embedding[k * 2 + 1]::DOUBLE * 1000 for k in range(4)]) AS x, 4::BIGINT AS n_lines FROM embeddings""")
def lines_explode(t):
    """A point is a line's first corner."""
    line = lambda p, i: F.struct(i.alias("index"), F.array(p[0], p[1], p[0], p[1]).alias("bbox"))
    payload = F.to_json(F.struct(F.col("vec_id").cast("string").alias("submission_id"), F.transform(_points(), line).alias("lines")))
    lines = consumer.lines_of(t("embeddings").select(payload.alias("text")))
    per_page = lines.groupBy("submission_id").agg(F.count("*").alias("n_lines"))
    return lines.join(per_page, "submission_id").select(F.col("submission_id").cast("long").alias("vec_id"), "index", F.col("bbox")[0].alias("x"), "n_lines")


@_query("""WITH p AS (SELECT vec_id, [embedding[k]::DOUBLE * 1000 for k in [1, 3, 5, 7]] AS xs, [embedding[k]::DOUBLE * 1000 for k in [2, 4, 6, 8]] AS ys FROM embeddings)
           SELECT vec_id, list_min(xs) AS x0, list_min(ys) AS y0, list_max(xs) AS x1, list_max(ys) AS y1, 4 AS corners FROM p""")
def lines_bbox(t):
    boxes = t("embeddings").select("vec_id", _box(_points()).alias("b"))
    return boxes.select("vec_id", *(F.col("b")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))), F.size(E.corners(F.col("b"))).alias("corners"))


@_query("""SELECT vec_id, embedding[1]::DOUBLE * 1000 * 0.5 AS x0, embedding[2]::DOUBLE * 1000 * 0.25 AS y0, embedding[7]::DOUBLE * 1000 * 0.5 AS x3, embedding[8]::DOUBLE * 1000 * 0.25 AS y3,
                  embedding[1]::DOUBLE * 1000 * 0.5 AS flat_x FROM embeddings""")
def rescale_coordinates(t):
    half, quarter = F.lit(0.5), F.lit(0.25)
    scaled = t("embeddings").select("vec_id", E.scaled_points(_points(), half, quarter).alias("p"), E.scaled(F.flatten(_points()), half, quarter).alias("f"))
    return scaled.select("vec_id", F.col("p")[0][0].alias("x0"), F.col("p")[0][1].alias("y0"), F.col("p")[3][0].alias("x3"), F.col("p")[3][1].alias("y3"), F.col("f")[0].alias("flat_x"))


@_query("""WITH p AS (SELECT vec_id, [[embedding[4 * k + 1]::DOUBLE * 1000, embedding[4 * k + 2]::DOUBLE * 1000, embedding[4 * k + 3]::DOUBLE * 1000, embedding[4 * k + 4]::DOUBLE * 1000] for k in range(4)] AS b FROM embeddings),
           n AS (SELECT vec_id, [[least(x[1], x[3]), least(x[2], x[4]), greatest(x[1], x[3]), greatest(x[2], x[4])] for x in b] AS b FROM p)
           SELECT vec_id, (coalesce(list_position([0 >= x[1] AND 0 <= x[3] AND 0 >= x[2] AND 0 <= x[4] for x in b], true), 0) - 1)::INTEGER AS hit FROM n""")
def bbox_hit_first(t):
    number = lambda k: F.element_at("embedding", k).cast("double") * 1000

    def box(k: int) -> Column:
        a, b, c, d = (number(4 * k + i) for i in (1, 2, 3, 4))
        return F.array(F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d))

    boxes = F.array(*map(box, range(4)))
    return t("embeddings").select("vec_id", E.first_hit(boxes, F.lit(0.0), F.lit(0.0)).alias("hit"))


def _edge(a: int, b: int) -> str:
    xa, ya, xb, yb = (f"embedding[{i}]::DOUBLE * 1000" for i in (2 * a + 1, 2 * a + 2, 2 * b + 1, 2 * b + 2))
    return f"CASE WHEN ({ya} > 0) <> ({yb} > 0) AND 0 < ({xb} - {xa}) * (0 - {ya}) / nullif({yb} - {ya}, 0) + {xa} THEN 1 ELSE 0 END"


@_query(f"""SELECT vec_id, ({" + ".join(_edge(k, (k - 1) % 4) for k in range(4))}) % 2 = 1 AS inside FROM embeddings""")
def point_in_polygon(t):
    return t("embeddings").select("vec_id", E.in_polygon(_points(), F.lit(0.0), F.lit(0.0)).alias("inside"))


def _crossing(a: int, b: int) -> str:
    return f"CASE WHEN (e[{2 * a + 2}] > y) <> (e[{2 * b + 2}] > y) AND x < (e[{2 * b + 1}] - e[{2 * a + 1}]) * (y - e[{2 * a + 2}]) / nullif(e[{2 * b + 2}] - e[{2 * a + 2}], 0) + e[{2 * a + 1}] THEN 1 ELSE 0 END"


@_query(f"""WITH l AS (SELECT label, vec_id AS line, list_transform(embedding, lambda v: v::DOUBLE * 1000) AS e FROM embeddings),
            p AS (SELECT label, line AS vec_id, e[13] AS x, e[14] AS y FROM l),
            m AS (SELECT p.vec_id, line, CASE WHEN line % 2 = 0 THEN ({_crossing(0, 3)} + {_crossing(1, 0)} + {_crossing(2, 1)} + {_crossing(3, 2)}) % 2 = 1
                         ELSE x BETWEEN least(e[9], e[11]) AND greatest(e[9], e[11]) AND y BETWEEN least(e[10], e[12]) AND greatest(e[10], e[12]) END AS inside
                  FROM p LEFT JOIN l USING (label))
            SELECT vec_id, coalesce(min(line) FILTER (WHERE inside), -1) AS line FROM m GROUP BY vec_id""")
def lines_at_points(t):
    """Points of all rows in the lines of their page, which is the label: even rows are lines by their polygon, odd ones by their box."""
    a, b, c, d, x, y = (F.get("embedding", F.lit(k)).cast("double") * 1000 for k in (8, 9, 10, 11, 12, 13))
    page = [F.col("label").cast("string").alias("submission_id"), F.lit("page").alias("image_filename")]
    rows = t("embeddings")
    lines = rows.select(*page, F.col("vec_id").alias("index"), F.array(F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d)).alias("bbox"), F.when(F.col("vec_id") % 2 == 0, _points()).alias("polygon"))
    return lines_at(lines, rows.select(*page, x.alias("x"), y.alias("y"), "vec_id")).select("vec_id", F.col("index").alias("line"))


@_query("""WITH g AS (SELECT event_id, date_sub('second', lag(ts) OVER (ORDER BY ts, event_id), ts) AS gap FROM events)
           SELECT event_id, gap, gap >= 900 AS aborts FROM g WHERE gap >= 90""")
def result_stall_gaps(t):
    return R.stall_gaps(t("events").select("event_id", "ts")).select("event_id", "gap", "aborts")


@_query("""SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, octet_length(encode(text)) AS size, md5(text) AS digest FROM documents WHERE text IS NOT NULL""")
def packed_artifacts(t):
    """All texts as artifacts of one commit, packed by tasks, and read back."""
    docs = t("documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.col("text").alias("content"))
    home = Storage(shared_folder(docs.sparkSession).removesuffix("/") + f"/packs-{uuid.uuid4().hex}")
    packs.pack(docs, home)
    return packs.packed(docs.sparkSession, home).select("path", "size", F.md5("content").alias("digest"))


@_query("""SELECT source AS submission_id, lang || '_p1.jpg' AS image_filename, count(*) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1""")
def output_name_collisions(t):
    stored = F.concat("lang", F.lit("."), F.when(F.col("n_chars") % 2 == 0, "jpg").otherwise("pdf"))
    return R.colliding_names(t("documents").select(F.col("source").alias("submission_id"), E.page_image_name(stored, F.lit(1)).alias("image_filename")))


@_query("""SELECT lang, count(*) AS n, avg(quality) AS quality, avg(toxic) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def consumer_stats(t):
    rated = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id")
    return consumer.statistics(rated.select(F.to_json(F.struct("lang", "quality", "toxic")).alias("metadata")), "lang", ("quality", "toxic"))


@_query("""WITH p AS (SELECT l_orderkey, CAST(l_partkey AS VARCHAR) || '_p' || CAST(l_linenumber AS VARCHAR) || '.jpg' AS image, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F')
           SELECT o_orderpriority AS priority, k::INTEGER AS index, count(*) AS lines, count(DISTINCT p.l_orderkey) AS submissions, sum(p.l_quantity * 2 + k) AS left_edges
           FROM p JOIN p AS q USING (l_orderkey, image) JOIN orders ON o_orderkey = p.l_orderkey, range(2) t(k) GROUP BY 1, 2""")
def consumer_training_rows(t):
    """Two lines a page, in images half as large as the raw ones; a line item that comes twice has its pages twice."""
    pages = _line_pages(t).filter("status = 'completed' AND image_filename <> ''")
    size = {"image_width": 40, "image_height": 30, "raw_image_width": 80, "raw_image_height": 60}
    left = F.col("l_quantity") + F.col("index") / 2
    items = t("lineitem").filter("l_returnflag = 'A' AND l_linestatus = 'F'")
    image = E.page_image_name(F.col("l_partkey").cast("string"), F.col("l_linenumber"))
    lines = items.select(F.col("l_orderkey").alias("submission_id"), image.alias("image_filename"), "l_quantity", F.explode(F.array(F.lit(0), F.lit(1))).alias("index"))
    lines = lines.withColumns({k: F.lit(v) for k, v in size.items()} | {"bbox": F.array(left, F.lit(1.0), left + 2, F.lit(3.0)), "polygon": F.array().cast("array<array<double>>")})
    subs = t("orders").select(F.col("o_orderkey").alias("submission_id"), F.to_json(F.struct(F.col("o_orderpriority").alias("priority"))).alias("metadata"))
    rows = consumer.training_rows(subs, pages, lines, ("priority",))
    return rows.groupBy("priority", "index").agg(
        F.count("*").alias("lines"), F.count_distinct("submission_id").alias("submissions"), F.sum(F.col("raw_bbox")[0]).alias("left_edges")
    )


@_query("""WITH p AS (SELECT l_orderkey AS id, CAST(l_partkey AS VARCHAR) || '.pdf' AS doc, l_linenumber AS n,
                      CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS VARCHAR) || '_p' || CAST(l_linenumber AS VARCHAR) || '.jpg' ELSE '' END AS image FROM lineitem)
           SELECT o_orderkey AS submission_id, '[' || o_orderstatus || '] ' || substr(CAST(o_orderkey AS VARCHAR), 1, 8) || '...' AS label, coalesce(doc, '') AS doc_filename, coalesce(n, -1) AS page_number, coalesce(image, '') AS image_filename,
                  CASE WHEN doc IS NOT NULL THEN (dense_rank() OVER (PARTITION BY o_orderkey ORDER BY doc) - 1)::INTEGER ELSE -1 END AS document,
                  CASE WHEN doc IS NOT NULL THEN (row_number() OVER (PARTITION BY o_orderkey, doc ORDER BY n, image) - 1)::INTEGER ELSE -1 END AS place
           FROM orders LEFT JOIN p ON id = o_orderkey""")
def viewer_tree(t):
    subs = t("orders").select(F.col("o_orderkey").alias("submission_id"), F.col("o_orderstatus").alias("status"))
    tree = consumer.tree(subs, _line_pages(t).withColumn("lines_filename", F.lit(""))).drop("lines_filename")
    return tree.fillna("", ["doc_filename", "image_filename"]).fillna(-1, ["page_number", "document", "place"])


@_query("""WITH z AS (SELECT event_id, coalesce(value, 0) AS v FROM events)
           SELECT event_id, greatest(0.1, least(10.0, v * 1.25)) AS zoom_in, greatest(0.1, least(10.0, v / 1.25)) AS zoom_out,
                  greatest(0.1, least(10.0, 800 / (v + 1), 600 / (v * 2 + 1))) AS fit, greatest(0.1, least(10.0, 800 / (v + 1))) AS fit_width,
                  CASE WHEN least(1.0, greatest(0.0, v / 100 + 0.1)) > least(1.0, greatest(0.0, 1 - v / 100 - 0.1)) THEN least(1.0, greatest(0.0, v / 100 + 0.1)) ELSE v / 100 END AS text_threshold FROM z""")
def viewer_zoom(t):
    v = F.coalesce("value", F.lit(0.0))
    width, height, room = v + 1, v * 2 + 1, (F.lit(800), F.lit(600))
    return t("events").select(
        "event_id",
        E.zoomed(v, 1.25).alias("zoom_in"),
        F.greatest(F.lit(0.1), F.least(F.lit(10.0), v / 1.25)).alias("zoom_out"),
        E.fitted(width, height, *room).alias("fit"),
        E.fitted_width(width, room[0]).alias("fit_width"),
        E.nudged(v / 100, 1 - v / 100, 0.1, -0.1)["text"].alias("text_threshold"),
    )


@_query("""SELECT event_id, substr(event_type || event_id, 1, 8) || '...' AS short,
                  format('[{:.0f}, {:.0f}, {:.0f}, {:.0f}]', value, -value, event_id / 2.0, 0.5) AS box, format('{:.3f}', event_id % 1024 / 1024) AS confidence,
                  CASE event_id % 3 WHEN 0 THEN 'JPEG' WHEN 1 THEN 'JPEG' ELSE 'PNG' END AS format FROM events""")
def viewer_texts(t):
    v, half = F.col("value"), F.col("event_id") / 2
    extension = F.element_at(F.array(F.lit(".jpg"), F.lit(""), F.lit("png")), (F.col("event_id") % 3 + 1).cast("int"))
    return t("events").select(
        "event_id",
        E.short_id(F.concat("event_type", F.col("event_id").cast("string"))).alias("short"),
        E.box_text(F.array(v, -v, half, F.lit(0.5))).alias("box"),
        E.confidence_text(F.col("event_id") % 1024 / 1024).alias("confidence"),
        E.image_format(extension).alias("format"),
    )


@_query("""SELECT vec_id, embedding[1]::DOUBLE * 1000 * (150 / 640) AS x0, embedding[2]::DOUBLE * 1000 * (100 / 480) AS y0 FROM embeddings""")
def thumbnail_scale(t):
    scaled = E.thumbnail(_points(), F.lit(640), F.lit(480), F.lit(150), F.lit(100))
    return t("embeddings").select("vec_id", scaled[0][0].alias("x0"), scaled[0][1].alias("y0"))


@_query("""SELECT doc_id, substr(text || '; ' || source, 1, 500) AS error FROM documents""")
def error_truncation(t):
    return t("documents").select("doc_id", E.error_text(F.array("text", "source")).alias("error"))


@_query("""SELECT doc_id, 1 AS page_number,
                  CASE WHEN n_chars % 5 = 4 THEN 'completed' ELSE 'failed' END AS status,
                  CASE n_chars % 5 WHEN 0 THEN 'Cannot read desc.json: ' || source WHEN 1 THEN 'Cannot parse desc.json: ' || source
                       WHEN 2 THEN 'Cannot read file: ' || source WHEN 3 THEN 'Failed to open PDF: ' || source ELSE '' END AS error FROM documents""")
def doc_failure_rows(t):
    from pagewright.operators.outcomes import failure_text

    stage = F.element_at(F.array(*map(F.lit, ("descriptor", "parse", "read", "open", ""))), (F.col("n_chars") % 5 + 1).cast("int"))
    error = failure_text(stage, F.col("source"))
    return t("documents").select("doc_id", F.lit(1).alias("page_number"), F.when(error == "", COMPLETED).otherwise(FAILED).alias("status"), error.alias("error"))
