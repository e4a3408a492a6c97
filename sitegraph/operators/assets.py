"""Image and document manifests (what the crawler saves next to a page).

Images: the page's distinct ``img[src]`` links in document order.
``data:image/...`` URLs are decoded in place (empty, undecodable or zero-byte
payloads are dropped; a data URL without ';' is dropped too); other URLs
are named from the decoded ``url=`` parameter if present, else from their
last path segment (``.jpg`` added when it has no dot).

Documents: the page's document links joined to the stored responses
(``url, status, disposition, body``); only status 200 is recorded; the file
name is the ``filename=`` part of Content-Disposition (quotes removed), else
the last path segment without query, URL-decoded.

``max_n`` > 0 keeps the first N *recorded* assets of a page (failures do not
count), by a per-page window; without stored responses nothing is known to fail and
the first N links of the row are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import urls as U
from sitegraph.operators import links as L

IMAGE_FOLDER = "images/"
DOCUMENT_FOLDER = "docs/"
_B64_RE = r"^[A-Za-z0-9+/]*={0,2}$"


def _b64_core(payload: Column) -> Column:
    return F.regexp_replace(payload, "=+$", "")


def _b64_ok(payload: Column) -> Column:
    """Strict base64: alphabet only, no white space, optional but correct
    padding, and at least one byte."""
    core = _b64_core(payload)
    pad_ok = (F.length(payload) == F.length(core)) | (F.length(payload) % 4 == 0)
    return payload.rlike(_B64_RE) & (F.length(core) % 4 != 1) & (F.length(core) >= 2) & pad_ok


def image_record(u: Column, run_ts: str, relative_path: str | None) -> Column:
    """struct(image_url, relative_path, file_name, mime_type, n_bytes, content, ok)."""
    is_data = u.startswith("data:image/")
    payload = F.regexp_extract(u, r"^[^,]*,(.*)$", 1)
    semi = F.instr(u, ";")
    d_mime = F.when(semi > 0, F.substring(u, 6, F.greatest(semi - 6, F.lit(0))))
    d_ext = F.substring_index(d_mime, "/", -1)
    d_ok = _b64_ok(payload) & (semi > 0)
    core = _b64_core(payload)
    padded = F.concat(core, F.repeat(F.lit("="), (F.lit(4) - F.length(core) % 4) % 4))
    d_bytes = F.when(d_ok, F.try_to_binary(padded, F.lit("base64")))
    d_n = F.when(d_ok, F.floor(F.length(core) * 6 / 8))
    decoded = U.embedded_url(u)
    name = U.image_file_name(decoded)
    web_ok = u.rlike(r"(?i)^(https?|ftp|file):")
    return F.struct(
        u.alias("image_url"),
        F.lit(relative_path).cast("string").alias("relative_path"),
        F.when(is_data, F.concat(F.lit("image_"), F.lit(run_ts), F.lit("."), d_ext)).otherwise(name)
        .alias("file_name"),
        F.when(is_data, d_mime).otherwise(U.mime_type(name)).alias("mime_type"),
        F.when(is_data, d_n).cast("bigint").alias("n_bytes"),
        F.when(is_data, d_bytes).alias("content"),
        F.when(is_data, d_ok).otherwise(web_ok).alias("ok"))


def image_manifest(pages_df: DataFrame, max_images: int = 0, run_ts: str = "00000000000000000",
                   relative_path: str | None = None, assets_df: DataFrame | None = None) -> DataFrame:
    """``page_id, url, pos, image_url, relative_path, file_name, mime_type,
    n_bytes, content`` for every linked image (row-local, no shuffle).

    With the stored responses ``assets_df`` only images that were fetched are recorded and
    counted, so a dead image uses up no place of ``max_images``; ``pos`` numbers them."""
    if assets_df is not None:
        d = asset_downloads(pages_df, assets_df, "images", max_images, run_ts, relative_path)
        pos = F.row_number().over(Window.partitionBy("page_id").orderBy("pos")) - 1
        return d.select("page_id", "url", pos.cast("bigint").alias("pos"), F.col("asset_url").alias("image_url"),
                        "relative_path", "file_name", "mime_type", "n_bytes", "content")
    df = L.with_links(pages_df.select("page_id", "url", "html"), ["images"], col="_imgs")
    imgs = F.col("_imgs")
    recs = F.filter(F.transform(imgs, lambda s: image_record(s["link"], run_ts, relative_path)),
                    lambda r: r["ok"])
    if max_images and max_images > 0:
        recs = F.slice(recs, 1, int(max_images))
    df = df.select("page_id", "url", F.posexplode(recs).alias("pos", "r"))
    return df.select("page_id", "url", F.col("pos").cast("bigint").alias("pos"), "r.image_url",
                     "r.relative_path", "r.file_name", "r.mime_type", "r.n_bytes", "r.content")


def asset_results(pages_df: DataFrame, assets_df: DataFrame, kind: str, run_ts: str = "00000000000000000",
                  relative_path: str | None = None) -> DataFrame:
    """What fetching every linked asset gives: ``page_id, url, pos, asset_url, relative_path, file_name,
    mime_type, n_bytes, content, status, kind`` with status ``ok`` or ``asset_failed``.

    ``kind`` is ``images``, ``documents`` or ``all`` (both from one reading of the pages and one join, each
    under its own folder); ``assets_df`` holds the stored responses (``url, status, disposition, body``).
    Data URLs carry their own bytes.  A response that is missing, not 200, without a body or without a
    decodable name is a failure: its row has no name and no bytes.
    """
    both = kind == "all"
    links = L.page_links(pages_df, ["images", "documents"] if both else [kind]).select(
        "page_id", "url", "kind", "pos", F.col("link").alias("asset_url"))
    a = assets_df.select(F.col("url").alias("asset_url"), F.col("status").alias("_st"),
                         F.col("disposition").alias("_disp"), F.col("body").cast("binary").alias("_body"))
    df = links.join(a, "asset_url", "left")
    u, image = F.col("asset_url"), F.col("kind") == "images"
    fetched = F.coalesce((F.col("_st") == 200) & F.col("_body").isNotNull(), F.lit(False))
    df = df.withColumn("_r", F.when(image, image_record(u, run_ts, None))).withColumn("_name", document_file_name(u, F.col("_disp")))
    is_data = image & u.startswith("data:image/")
    name = F.when(image, F.col("_r.file_name")).otherwise(F.col("_name"))
    mime = F.when(image, F.col("_r.mime_type")).otherwise(U.mime_type(F.col("_name")))
    body = F.when(is_data, F.col("_r.content")).otherwise(F.col("_body"))
    ok = F.coalesce(F.when(is_data, F.col("_r.ok") & F.col("_r.content").isNotNull())
                    .otherwise(fetched & (image | F.col("_name").isNotNull())), F.lit(False))
    folder = F.when(image, F.lit(IMAGE_FOLDER)).otherwise(F.lit(DOCUMENT_FOLDER)) if both else F.lit(relative_path).cast("string")
    return df.select("page_id", "url", F.col("pos").cast("bigint").alias("pos"), "asset_url",
                     folder.alias("relative_path"), F.when(ok, name).alias("file_name"),
                     F.when(ok, mime).alias("mime_type"), F.when(ok, F.octet_length(body)).cast("bigint").alias("n_bytes"),
                     F.when(ok, body).alias("content"), F.when(ok, F.lit("ok")).otherwise(F.lit("asset_failed")).alias("status"), "kind")


def asset_downloads(pages_df: DataFrame, assets_df: DataFrame, kind: str, max_n: int = 0, run_ts: str = "00000000000000000",
                    relative_path: str | None = None, max_documents: int = 0) -> DataFrame:
    """The recorded assets of each page with their bytes: ``asset_results`` that are ok, the first ``max_n``
    of a page if that is over 0.  Failures are not recorded and use up no place of the limit.  With kind ``all``
    ``max_n`` holds for images and ``max_documents`` for documents."""
    ok = asset_results(pages_df, assets_df, kind, run_ts, relative_path).where("status = 'ok'").drop("status")
    limits = {"images": int(max_n or 0), "documents": int(max_documents or 0)} if kind == "all" else {kind: int(max_n or 0)}
    if any(limits.values()):  # a page's own links
        w = Window.partitionBy("page_id", "kind").orderBy("pos")
        most = F.lit(0)
        for k, n in limits.items():
            most = F.when(F.col("kind") == k, F.lit(n)).otherwise(most)
        ok = ok.withColumn("_n", F.row_number().over(w)).where((most <= 0) | (F.col("_n") <= most)).drop("_n")
    return ok


def saved_assets(downloads: DataFrame, folder: str) -> DataFrame:
    """Writes downloads as files under their names (``sources.files``); ``key, file_name, n_bytes, path``, with the
    asset's URL as key.  An asset that many pages link to is saved once."""
    from sitegraph.sources import files
    each = downloads.groupBy(F.col("asset_url").alias("key"), "file_name").agg(F.first("content").alias("content"))
    return files.save(each, folder)


def document_file_name(url: Column, disposition: Column) -> Column:
    """Content-Disposition ``filename=`` (quotes removed) or the last path
    segment without query; URL-decoded (NULL when not decodable)."""
    from_disp = F.replace(F.regexp_extract(disposition, r"(?s)filename=(.*)$", 1), F.lit('"'), F.lit(""))
    from_url = F.substring_index(F.split(url, r"\?")[0], "/", -1)
    raw = F.when(F.coalesce(disposition.contains("filename="), F.lit(False)), from_disp).otherwise(from_url)
    return F.try_url_decode(raw)


def document_manifest(pages_df: DataFrame, assets_df: DataFrame, max_documents: int = 0,
                      relative_path: str | None = None) -> DataFrame:
    """``page_id, url, pos, doc_url, relative_path, file_name, mime_type``
    for every recorded document (stored status 200)."""
    links = L.page_links(pages_df, ["documents"]).select(
        "page_id", "url", "pos", F.col("link").alias("doc_url"))
    a = assets_df.select(F.col("url").alias("doc_url"), "status", "disposition")
    df = links.join(a, "doc_url").where(F.col("status") == 200)
    df = df.withColumn("file_name", document_file_name(F.col("doc_url"), F.col("disposition"))) \
           .where(F.col("file_name").isNotNull())
    if max_documents and max_documents > 0:
        w = Window.partitionBy("page_id").orderBy("pos")
        df = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= int(max_documents))
    return df.select("page_id", "url", F.col("pos").cast("bigint").alias("pos"), "doc_url",
                     F.lit(relative_path).cast("string").alias("relative_path"), "file_name",
                     U.mime_type(F.col("file_name")).alias("mime_type"))


def single_asset(urls_df: DataFrame, assets_df: DataFrame, run_ts: str = "00000000000000000",
                 url_col: str = "url") -> DataFrame:
    """A URL that is itself an asset is recorded alone: documents through
    the stored response, images (image MIME type by name, or data URL) by
    name.  Other URLs are pages: ``kind = 'page'`` and no file."""
    u = F.col(url_col)
    img = image_record(u, run_ts, None)
    a = assets_df.select(F.col("url").alias("_au"), F.col("status").alias("_st"),
                         F.col("disposition").alias("_disp"))
    df = urls_df.join(a, u == F.col("_au"), "left")
    is_doc = U.is_document(u)
    is_img = u.startswith("data:image/") | U.mime_type(img["file_name"]).startswith("image/")
    doc_name = F.when(F.col("_st") == 200, document_file_name(u, F.col("_disp")))
    kind = F.when(is_doc, F.lit("document")).when(is_img, F.lit("image")).otherwise(F.lit("page"))
    name = (F.when(is_doc, doc_name).when(is_img & img["ok"], img["file_name"]))
    mime = F.when(is_doc, U.mime_type(doc_name)).when(is_img & img["ok"], img["mime_type"])
    return df.select(*urls_df.columns, kind.alias("kind"), name.alias("file_name"), mime.alias("mime_type"))


def mime_inventory(pages_df: DataFrame) -> DataFrame:
    """Linked assets per host and MIME type: ``host, mime_type, n_links,
    n_urls`` over all image and document links of all pages."""
    links = L.page_links(pages_df, ["images", "documents"])
    name = F.when(F.col("kind") == "images", image_record(F.col("link"), "0", None)["file_name"]) \
        .otherwise(F.substring_index(F.split(F.col("link"), r"\?")[0], "/", -1))
    mime = F.when(F.col("link").startswith("data:image/"),
                  image_record(F.col("link"), "0", None)["mime_type"]).otherwise(U.mime_type(name))
    return (links.select(U.host(F.col("link")).alias("host"), mime.alias("mime_type"), "link")
            .groupBy("host", "mime_type")
            .agg(F.count("*").alias("n_links"), F.countDistinct("link").alias("n_urls")))
