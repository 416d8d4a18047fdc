"""One query per operator over the test tables, and the same in SQL for DuckDB.

Documents stand for recognised pages: a source is a book, a page's name comes from its id. Every third
page is given artefacts of recognition, the same in both engines, since the tables hold none. Labels
stand for page images and for finished work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow import providers
from vellumflow.functions import messages, names, text
from vellumflow.operators import assemble, audio, chunking, pages, scan
from vellumflow.plans import runs, stages
from vellumflow.sources import files
from vellumflow.streaming.resume import process_new

HEAD = "ﬁrst oﬀ — the – end… Preprint’ épreprint preprintſ\r\nDetected 5\n diacritics and NO best  wordſ!! kept\ninfor-\n mation a-\nb-\nc\n\xa0 padded \xa0\n---\n« »\n$+=\n|\nx  y\t\tz\n"
TAIL = "\nA line's   end \t \n...\n"
LIMIT = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents")
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(HEAD), "text", F.lit(TAIL))).otherwise(F.col("text"))
    return d.select("doc_id", F.col("source").alias("book"), F.format_string("page_%04d", "doc_id").alias("base"), marked.alias("text"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as images of their pages."""
    seen = _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return _pages(spark, sf_dir).drop("text").join(seen, "doc_id")


def _text_query(change):
    return lambda spark, sf_dir: _pages(spark, sf_dir).select("doc_id", change(F.col("text")).alias("text"))


def discover_by_suffix(spark, sf_dir):
    name = names.file_name(F.col("url"))
    found = _table(spark, sf_dir, "pages").select("page_id", F.concat(name, F.when(F.col("page_id") % 2 == 0, ".PDF").otherwise(".txt")).alias("file_name"))
    return found.where(names.has_suffix(F.col("file_name"), ".pdf")).select("page_id", names.book_name(F.col("file_name")).alias("book"))


def count_by_suffix(spark, sf_dir):
    name = F.concat(names.file_name(F.col("url")), F.when(F.col("page_id") % 2 == 0, ".PDF").otherwise(".txt"))
    return _table(spark, sf_dir, "pages").groupBy(names.extension(name).alias("suffix")).agg(F.count("*").alias("n_files"))


def page_sequence(spark, sf_dir):
    books = _table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("book")).agg(F.count("*").alias("pages"))
    return pages.page_jobs(books).select("book", "page_no", "file_name")


def page_pairs(spark, sf_dir):
    images = _images(spark, sf_dir).select("book", "base", F.concat("base", F.lit(".png")).alias("image"))
    found = pages.page_pairs(_pages(spark, sf_dir), images)
    return found.select("book", "base", "image", F.octet_length("text").cast("long").alias("n_bytes"))


def pairs_last_wins(spark, sf_dir):
    p = _pages(spark, sf_dir).select("book", "base")
    both = p.withColumn("file_name", F.explode(F.array(F.concat("base", F.lit(".jpg")), F.concat("base", F.lit(".png")))))
    return pages.last_wins(both).select("book", "base", "file_name")


def books_with_images(spark, sf_dir):
    books = _table(spark, sf_dir, "documents").select(F.col("source").alias("book")).distinct()
    return pages.books_with(books, _images(spark, sf_dir))


def pending_work(spark, sf_dir):
    done = _images(spark, sf_dir).select("book", "base", F.col("quality").alias("length"))
    return pages.pending(_pages(spark, sf_dir).select("book", "base"), done, pages.KEYS)


def _named(spark, sf_dir):
    """Pages with names of several kinds."""
    kind = F.when(F.col("doc_id") % 5 == 0, F.format_string("Page %d", "doc_id")).when(F.col("doc_id") % 5 == 1, F.format_string("subpage_%d", "doc_id"))
    kind = kind.when(F.col("doc_id") % 5 == 2, F.format_string("Cover %d", "doc_id")).when(F.col("doc_id") % 5 == 3, F.format_string("page-99999999999999999999 %d", "doc_id"))
    return _pages(spark, sf_dir).select("book", kind.otherwise(F.col("base")).alias("base"))


def document_order(spark, sf_dir):
    return pages.in_order(_named(spark, sf_dir)).select("book", "base", "doc_ord")


def limit_pages(spark, sf_dir):
    return pages.in_order(_named(spark, sf_dir), LIMIT).select("book", "base", "doc_ord")


def concat_terminated(spark, sf_dir):
    p = _pages(spark, sf_dir).withColumn("file_name", F.concat("base", F.lit(".txt")))
    return assemble.concat_terminated(p).select("book", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("n_bytes"))


def concat_separated(spark, sf_dir):
    p = _pages(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")))
    return assemble.concat_separated(p, "base").select("book", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("n_bytes"))


def chunk_text(spark, sf_dir):
    rows = _pages(spark, sf_dir).select(F.col("doc_id").alias("book"), "text")
    return chunking.chunks(rows)


def chunk_counts(spark, sf_dir):
    return chunking.chunk_counts(_pages(spark, sf_dir).select(F.col("doc_id").alias("book"), "text"))


def narration_chunks(spark, sf_dir):
    """Pages cleaned, put in order and packed, as the narrations that they make up are: the flow from pages to
    speech. A book here is a source, with any number of pages, so that it is never one row."""
    return narration_scan(spark, sf_dir).withColumn("chunk_no", F.col("chunk_no").cast("int"))


def narration_scan(spark, sf_dir):
    """The same chunks, packed from pages that are never joined to a text per book."""
    return scan.chunks_of_pages(_pages(spark, sf_dir), names.document_order(F.col("base")), change=text.clean_or_raw)


def mime_type(spark, sf_dir):
    ext = F.element_at(F.array(*(F.lit(x) for x in (".png", ".JPG", ".jpeg", ".WebP", ".bin", ""))), (F.col("page_id") % 6 + 1).cast("int"))
    return _table(spark, sf_dir, "pages").select("page_id", names.mime_type(F.concat(F.lit("p"), "page_id", ext)).alias("mime"))


def encode_payload(spark, sf_dir):
    messages.unbroken_base64(spark)
    return _table(spark, sf_dir, "pages").select("page_id", messages.encode_payload(F.col("html").cast("binary")).alias("data"))


def build_prompt(spark, sf_dir):
    p = _pages(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 4 == 0, " \n\t").otherwise(F.col("text")))
    return p.select("doc_id", messages.build_prompt(F.col("text"), "Narrate.").alias("prompt"))


def build_request(spark, sf_dir):
    """The request read back: role, text, media type, data and all settings."""
    messages.unbroken_base64(spark)
    made = messages.build_request(messages.build_prompt(F.col("text"), "Narrate."), F.lit("image/png"), messages.encode_payload(F.col("base").cast("binary")))
    rows = _pages(spark, sf_dir).select("doc_id", made.alias("r"))
    at = lambda path: F.get_json_object("r", f"$.{path}")
    part = "contents[0].parts"
    return rows.select("doc_id", at("contents[0].role").alias("role"), at(f"{part}[0].text").alias("text"), at(f"{part}[1].inlineData.mimeType").alias("mime"), at(f"{part}[1].inlineData.data").alias("data"), at("generationConfig.topK").cast("int").alias("top_k"), at("generationConfig.temperature").cast("double").alias("temperature"), at("generationConfig.topP").cast("double").alias("top_p"), at("generationConfig.maxOutputTokens").cast("int").alias("max_tokens"))


def _responses(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    part = lambda t: F.struct(t.alias("text"))
    good = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(part(F.col("role")), part(F.lit("  ")), part(F.col("text"))).alias("parts")).alias("content"))).alias("candidates")))
    kind = F.col("turn") % 5
    body = F.when(kind == 1, F.lit('{"candidates":[]}')).when(kind == 2, F.lit('{"error":{"message":"quota"}}')).when(kind == 3, F.lit("not json")).otherwise(good)
    return c.select("conv_id", "turn", F.when(kind == 2, 429).when(kind == 3, 502).otherwise(200).alias("status"), body.alias("body"))


def parse_response(spark, sf_dir):
    r = _responses(spark, sf_dir).withColumn("r", messages.parse_response(F.col("status"), F.col("body")))
    return r.select("conv_id", "turn", F.col("r.text").alias("text"), F.col("r.error").alias("error"))


def blank_filter(spark, sf_dir):
    """Verdicts of a blank detector, whose exit codes are made up from doc_id; a page whose check fails stays."""
    p = _pages(spark, sf_dir).withColumn("code", (F.col("doc_id") % 4).cast("int"))
    checked = p.withColumn("v", names.blank_verdict(F.col("code")))
    return pages.not_blank(checked, F.col("v.blank")).select("doc_id", F.col("v.error").alias("error"))


def error_rollup(spark, sf_dir):
    rows = _images(spark, sf_dir).withColumn("error", F.when(F.col("toxic") == 1, "bad"))
    return assemble.error_rollup(rows, "book")


def whole_groups(spark, sf_dir):
    rows = _images(spark, sf_dir).withColumn("error", F.when((F.col("toxic") == 1) & (F.col("doc_id") % 2 == 0), "bad"))
    return assemble.whole_groups(rows, "book").select("book", "base")


def page_numbers(spark, sf_dir):
    return _named(spark, sf_dir).select("book", "base", names.page_number(F.col("base")).alias("page_number"))


def page_counts(spark, sf_dir):
    report = F.concat(F.lit("Title: x\nPages:          "), F.when(F.col("turn") % 3 == 0, "none").otherwise(F.col("turn").cast("string")), F.lit("\nSize: 1"))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", names.page_count(report).alias("pages"))


def fake_ocr(spark, sf_dir):
    images = _pages(spark, sf_dir).select("book", "base", F.col("text").cast("binary").alias("content"))
    done = _images(spark, sf_dir).select("book", "base", F.col("quality").alias("length"))
    return stages.recognise(images, done, providers.Ocr(providers.fake_recognise))


def _flaky(model: str, row: dict) -> str:
    if row["doc_ord"] % 3 == 0 or (row["doc_ord"] % 3 == 1 and model == "light"):
        raise OSError("no answer")
    return providers.fake_model(model, {"prompt": row["base"]})


def retry_fallback(spark, sf_dir):
    images = _images(spark, sf_dir).select("book", "base", F.col("base").cast("binary").alias("content"))
    ask = providers.Retry(_flaky, pause_s=0.0)
    return stages.augment(_pages(spark, sf_dir), images, ask).select("book", "base", "doc_ord", "text", "error")


def _spoken(spark, sf_dir):
    narrations = assemble.concat_separated(_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("book"), "turn", "text"), "turn")
    done = narrations.select("book", F.lit(0).alias("chunk_no"), F.lit("").alias("content_hash"), F.lit(1).alias("length"))
    return stages.speak(narrations, done, providers.fake_speech)


def resample_pcm(spark, sf_dir):
    """Bytes of samples before and after: 24 kHz at 16 bits to 48 kHz at 32 bits makes four of each."""
    out = _spoken(spark, sf_dir).withColumn("r", audio.resample(F.col("wav")))
    return out.select("book", "chunk_no", (F.length("wav") - 44).cast("long").alias("before"), (F.length("r.value") - 44).cast("long").alias("after"), F.col("r.error").alias("error"))


def concat_audio(spark, sf_dir):
    return audio.concat_audio(_spoken(spark, sf_dir)).select("book", (F.length("wav") - 44).cast("long").alias("n_bytes"))


def encode_books(spark, sf_dir):
    """Bytes of samples of each book, encoded and decoded again: those of its text, at twice the rate and depth."""
    coded = stages.encode(_spoken(spark, sf_dir), providers.fake_encode).withColumnRenamed("error", "failed")
    read = providers.run(coded, lambda: providers.fake_decode, ["book", "failed"], "wav", "binary")
    return read.select("book", (F.length("wav") - 44).cast("long").alias("n_bytes"), F.coalesce("failed", "error").alias("error"))


def resume_stream(spark, sf_dir):
    """The documents taken up by a stream that runs twice; the second run finds nothing new."""
    at, source = files.shared_folder(spark), f"{sf_dir}/documents.parquet"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for _ in range(2):
        out = process_new(spark, source, schema, lambda d: d.select("doc_id", text.clean_or_raw(F.col("text")).alias("text")), f"{at}/out", f"{at}/log")
    return out


def _ocr_of_run(number: int):
    """Says which run it is called in; the first fails at every seventh page."""

    def ocr(row: dict) -> str:
        if number == 1 and int(row["base"][5:]) % 7 == 0:
            raise OSError("no answer")
        return str(number)

    return ocr


def run_resumed(spark, sf_dir):
    """The run that each page's text is from, of two: the second asks for pages that the first failed at
    and for those that have another image now, every fifth."""
    named = _pages(spark, sf_dir).select("doc_id", F.coalesce("book", F.lit("")).alias("book"), "base", F.coalesce("text", F.lit("")).alias("text"))
    folder = files.shared_folder(spark)
    for number in (1, 2):
        image = F.when((F.col("doc_id") % 5 == 0) & F.lit(number == 2), F.concat("text", F.lit(" again"))).otherwise(F.col("text"))
        images = named.select("book", "base", image.cast("binary").alias("content")).withColumn("content_hash", F.sha2("content", 256))
        out = runs.Run(spark, folder).resume("text", images, lambda done, n=number, i=images: stages.recognise(i, done, _ocr_of_run(n), 0, runs.PAGE), runs.PAGE, "text")
    return out.select("book", "base", "text", "error")


# The same in SQL.

_quote = lambda s: "'" + s.replace("'", "''") + "'"
_P = f"p AS (SELECT doc_id, source AS book, printf('page_%04d', doc_id) AS base, CASE WHEN doc_id % 3 = 0 THEN {_quote(HEAD)} || text || {_quote(TAIL)} ELSE text END AS text FROM documents)"
_IM = "im AS (SELECT p.doc_id, book, base, quality, toxic FROM p JOIN labels l ON p.doc_id = l.doc_id)"
_NAMED = "nm AS (SELECT book, CASE doc_id % 5 WHEN 0 THEN 'Page ' || doc_id WHEN 1 THEN 'subpage_' || doc_id WHEN 2 THEN 'Cover ' || doc_id WHEN 3 THEN 'page-99999999999999999999 ' || doc_id ELSE base END AS base FROM p), num AS (SELECT *, regexp_extract(base, '(?i)page[_\\-\\s]*(\\d+)', 1) AS digits FROM nm), ordered AS (SELECT book, base, CASE WHEN digits <> '' THEN coalesce(try_cast(digits AS BIGINT), 0) END AS n FROM num)"


def _sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {_quote(pattern)}, {_quote(to)}, 'g')"


def _sql_chars(x: str) -> str:
    for old, new in text.REPLACED:
        x = f"replace({x}, {_quote(old)}, {_quote(new)})"
    return x


def _sql_artifacts(x: str) -> str:
    return _sub(_sub(_sub(x, "(?i)\\bpreprints?\\b['’]*"), "(?i)\\bdetected\\s+\\d+\\s+diacritics\\b"), "(?i)no\\s+best\\s+words!+")


def _sql_hyphens(x: str) -> str:
    return _sub(x, "([a-z])-\\s*\\n\\s*([a-z])", "\\1\\2")


def _trim(x: str) -> str:
    return f"trim({x}, {_quote(text.WHITE_SPACE)})"


def _sql_lines(x: str) -> str:
    kept = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {_trim('l')}), lambda l: l <> '' AND NOT regexp_full_match(l, '[\\p{{P}}\\s]+'))"
    return f"array_to_string(list_transform({kept}, lambda l: {_sub('l', '[ \\t]{2,}', ' ')}), chr(10))"


def _sql_clean(x: str) -> str:
    return _trim(_sql_lines(_sql_hyphens(_sql_artifacts(_sql_chars(x)))))


def _sql_text(expression: str) -> str:
    return f"WITH {_P} SELECT doc_id, {expression} AS text FROM p"


def _sql_chunks(rows: str, result: str = "SELECT book, chunk_no, chunk, sha256(chunk) AS content_hash FROM g") -> str:
    """Chunks of rows(book, text) as a CTE named n."""
    return f"""WITH RECURSIVE {rows}, l AS (
  SELECT book, row_number() OVER (PARTITION BY book ORDER BY i) AS i, line, strlen(line) AS size
  FROM (SELECT book, i, {_trim('line')} AS line FROM (SELECT book, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM n)) WHERE line <> ''
), c AS (
  SELECT book, i, line, 1 AS chunk_no, size FROM l WHERE i = 1
  UNION ALL
  SELECT l.book, l.i, l.line, c.chunk_no + (c.size + l.size + 1 > 200)::INT, CASE WHEN c.size + l.size + 1 > 200 THEN l.size ELSE c.size + l.size + 1 END
  FROM c JOIN l ON l.book = c.book AND l.i = c.i + 1
), g AS (SELECT book, CAST(chunk_no AS INT) AS chunk_no, string_agg(line, ' ' ORDER BY i) AS chunk FROM c GROUP BY book, chunk_no)
{result}"""


_NARRATED = f"{_P}, cl AS (SELECT *, {_sql_clean('text')} AS cleaned FROM p), n AS (SELECT book, string_agg(t, chr(10) || chr(10) ORDER BY doc_id) AS text FROM (SELECT book, doc_id, CASE WHEN cleaned = '' THEN text ELSE cleaned END AS t FROM cl) WHERE t <> '' GROUP BY book)"
_TOLD = "n AS (SELECT CAST(conv_id AS VARCHAR) AS book, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn, text) FILTER (text <> ''), '') AS text FROM conversations GROUP BY conv_id)"
_ORDER = "row_number() OVER (PARTITION BY book ORDER BY (n IS NULL), n, lower(base), base)"
_URL_NAME = "regexp_extract(url, '([^/]*)$', 1) || CASE WHEN page_id % 2 = 0 THEN '.PDF' ELSE '.txt' END"
_PROMPT = lambda x: f"'Narrate.' || {_quote(messages.MARKER)} || CASE WHEN {_trim(x)} = '' THEN {_quote(messages.NO_TEXT)} ELSE {_trim(x)} END"

ORACLE_SQL = {
    "normalize_chars": _sql_text(_sql_chars("text")),
    "strip_artifacts": _sql_text(_sql_artifacts("text")),
    "join_hyphens": _sql_text(_sql_hyphens("text")),
    "normalize_lines": _sql_text(_sql_lines("text")),
    "clean_text": _sql_text(f"CASE WHEN {_sql_clean('text')} = '' THEN text ELSE {_sql_clean('text')} END"),
    "discover_by_suffix": f"SELECT page_id, regexp_replace(f, '(?i)\\.pdf$', '') AS book FROM (SELECT page_id, {_URL_NAME} AS f FROM pages) WHERE lower(f) LIKE '%.pdf'",
    "count_by_suffix": f"SELECT lower(regexp_extract({_URL_NAME}, '(\\.[^./]*)$', 1)) AS suffix, count(*) AS n_files FROM pages GROUP BY 1",
    "page_sequence": "SELECT book, CAST(n AS INT) AS page_no, printf('page_%04d.png', n) AS file_name FROM (SELECT conv_id AS book, unnest(range(1, count(*) + 1)) AS n FROM conversations GROUP BY conv_id)",
    "page_pairs": f"WITH {_P}, {_IM} SELECT p.book, p.base, im.base || '.png' AS image, strlen(p.text) AS n_bytes FROM p JOIN im ON p.book = im.book AND p.base = im.base",
    "pairs_last_wins": f"WITH {_P} SELECT book, base, max(f) AS file_name FROM (SELECT book, base, unnest([base || '.jpg', base || '.png']) AS f FROM p) GROUP BY book, base",
    "books_with_images": f"WITH {_P}, {_IM} SELECT DISTINCT book FROM p WHERE EXISTS (SELECT 1 FROM im WHERE im.book = p.book)",
    "pending_work": f"WITH {_P}, {_IM} SELECT book, base FROM p WHERE NOT EXISTS (SELECT 1 FROM im WHERE im.book = p.book AND im.base = p.base AND quality > 0)",
    "document_order": f"WITH {_P}, {_NAMED} SELECT book, base, CAST({_ORDER} AS INT) AS doc_ord FROM ordered",
    "limit_pages": f"WITH {_P}, {_NAMED} SELECT book, base, CAST({_ORDER} AS INT) AS doc_ord FROM ordered QUALIFY doc_ord <= {LIMIT}",
    "concat_terminated": f"WITH {_P} SELECT book, sha256(t) AS text_sha256, strlen(t) AS n_bytes FROM (SELECT book, string_agg(text || chr(10) || chr(10), '' ORDER BY base || '.txt', text) AS t FROM p GROUP BY book)",
    "concat_separated": f"WITH {_P} SELECT book, sha256(t) AS text_sha256, strlen(t) AS n_bytes FROM (SELECT book, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY base, text) FILTER (text <> '' AND doc_id % 7 <> 0), '') AS t FROM p GROUP BY book)",
    "chunk_text": _sql_chunks(f"{_P}, n AS (SELECT doc_id AS book, text FROM p)"),
    "chunk_counts": _sql_chunks(f"{_P}, n AS (SELECT doc_id AS book, text FROM p)", "SELECT n.book, count(g.chunk_no) AS n_chunks FROM n LEFT JOIN g ON n.book = g.book GROUP BY n.book"),
    "narration_chunks": _sql_chunks(_NARRATED),
    "narration_scan": _sql_chunks(_NARRATED, "SELECT book, CAST(chunk_no AS BIGINT) AS chunk_no, chunk, sha256(chunk) AS content_hash FROM g"),
    "mime_type": "SELECT page_id, CASE page_id % 6 WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/jpeg' WHEN 3 THEN 'image/webp' ELSE 'image/png' END AS mime FROM pages",
    "encode_payload": "SELECT page_id, base64(encode(html)) AS data FROM pages",
    "build_prompt": f"WITH {_P} SELECT doc_id, {_PROMPT('text')} AS prompt FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE text END AS text FROM p)",
    "build_request": f"WITH {_P} SELECT doc_id, 'user' AS role, {_PROMPT('text')} AS text, 'image/png' AS mime, base64(encode(base)) AS data, 40 AS top_k, CAST(0.1 AS DOUBLE) AS temperature, CAST(0.95 AS DOUBLE) AS top_p, 8192 AS max_tokens FROM p",
    "parse_response": f"SELECT conv_id, turn, CASE WHEN turn % 5 IN (0, 4) THEN array_to_string(list_filter([role, '  ', text], lambda x: {_trim('x')} <> ''), chr(10)) END AS text, CASE turn % 5 WHEN 1 THEN '{messages.NO_CANDIDATES}' WHEN 2 THEN 'HTTP 429: quota' WHEN 3 THEN 'HTTP 502: not json' END AS error FROM conversations",
    "blank_filter": "SELECT doc_id, CASE WHEN doc_id % 4 > 1 THEN 'blank detector exit code ' || (doc_id % 4) END AS error FROM documents WHERE doc_id % 4 <> 0",
    "error_rollup": f"WITH {_P}, {_IM} SELECT book, count(*) AS n_rows, count(*) FILTER (toxic = 1) AS n_errors, bool_or(coalesce(toxic, 0) = 1) AS any_error FROM im GROUP BY book",
    "whole_groups": f"WITH {_P}, {_IM} SELECT book, base FROM im WHERE book NOT IN (SELECT book FROM im WHERE toxic = 1 AND doc_id % 2 = 0)",
    "page_numbers": f"WITH {_P}, {_NAMED} SELECT book, base, n AS page_number FROM ordered",
    "page_counts": "SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 AND turn > 0 THEN CAST(turn AS INT) END AS pages FROM conversations",
    "fake_ocr": f"WITH {_P}, {_IM}, w AS (SELECT book, base, text FROM p WHERE NOT EXISTS (SELECT 1 FROM im WHERE im.book = p.book AND im.base = p.base AND quality > 0)) SELECT book, base, CASE WHEN {_sql_clean('text')} = '' THEN text ELSE {_sql_clean('text')} END AS text, CAST(NULL AS VARCHAR) AS error FROM w",
    "retry_fallback": f"WITH {_P}, {_IM}, o AS (SELECT p.book, p.base, CAST(row_number() OVER (PARTITION BY p.book ORDER BY p.doc_id) AS INT) AS doc_ord FROM p JOIN im ON p.book = im.book AND p.base = im.base) SELECT book, base, doc_ord, CASE doc_ord % 3 WHEN 1 THEN '[standard] ' || base WHEN 2 THEN '[light] ' || base END AS text, CASE WHEN doc_ord % 3 = 0 THEN 'RuntimeError: model large attempt 3/3: no answer' END AS error FROM o",
    "resample_pcm": _sql_chunks(_TOLD, "SELECT book, chunk_no, 2 * strlen(chunk) AS before, 8 * strlen(chunk) AS after, CAST(NULL AS VARCHAR) AS error FROM g"),
    "concat_audio": _sql_chunks(_TOLD, "SELECT book, CAST(sum(2 * strlen(chunk)) AS BIGINT) AS n_bytes FROM g GROUP BY book"),
    "encode_books": _sql_chunks(_TOLD, "SELECT book, CAST(sum(8 * strlen(chunk)) AS BIGINT) AS n_bytes, CAST(NULL AS VARCHAR) AS error FROM g GROUP BY book"),
    "run_resumed": "SELECT coalesce(source, '') AS book, printf('page_%04d', doc_id) AS base, CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN '2' ELSE '1' END AS text, CAST(NULL AS VARCHAR) AS error FROM documents",
    "resume_stream": f"SELECT doc_id, CASE WHEN {_sql_clean('text')} = '' THEN text ELSE {_sql_clean('text')} END AS text FROM documents",
}

QUERIES = {
    "normalize_chars": _text_query(text.normalize_chars),
    "strip_artifacts": _text_query(text.strip_artifacts),
    "join_hyphens": _text_query(text.join_hyphens),
    "normalize_lines": _text_query(text.normalize_lines),
    "clean_text": _text_query(text.clean_or_raw),
} | {
    f.__name__: f
    for f in (
        discover_by_suffix, count_by_suffix, page_sequence, page_pairs, pairs_last_wins, books_with_images, pending_work, document_order, limit_pages,
        concat_terminated, concat_separated, chunk_text, chunk_counts, narration_chunks, narration_scan, mime_type, encode_payload, build_prompt, build_request, parse_response,
        blank_filter, error_rollup, whole_groups, page_numbers, page_counts, fake_ocr, retry_fallback, resample_pcm, concat_audio, encode_books, resume_stream, run_resumed,
    )
}
