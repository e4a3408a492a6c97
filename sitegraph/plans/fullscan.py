"""Full-scan page records: what the crawl saves for every page it visits.

``{url, title, imageFiles?, documentFiles?, metaTags?, content}``: optional
parts are arrays assembled per page.  Meta tags are row-local; images and documents are
those that were fetched: the pages' links, without the HTML, meet the stored responses in
one join for both kinds, and are grouped by page (bounded by the page's own links).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.operators import assets as A
from sitegraph.operators import content as C
from sitegraph.operators import meta as M


def full_scan_records(pages_df: DataFrame, assets_df: DataFrame | None = None, *, fmt: str = "text",
                      selectors: list[str] | None = None, with_images: bool = False,
                      with_documents: bool = False, with_meta: bool = False, max_images: int = 0,
                      max_documents: int = 0, run_ts: str = "00000000000000000") -> DataFrame:
    """``page_id, url, title, imageFiles, documentFiles, metaTags, content``.

    ``assets_df`` holds the stored responses of images and documents (``url, status,
    disposition, body``); without it only images that are data URLs are recorded."""
    out = C.with_content(pages_df.select("page_id", "url", "html"), fmt, selectors)
    cols = ["page_id", "url", "title", "content"]
    if with_meta:
        out = out.withColumn("metaTags", M.meta_array(H.clean_html(F.col("html"))))
        cols.append("metaTags")
    out = out.select(*cols)
    if not with_images and not with_documents:
        return out
    if assets_df is None:
        assets_df = out.sparkSession.createDataFrame([], "url string, status int, disposition string, body string")
    kind = "all" if with_images and with_documents else "images" if with_images else "documents"
    folder = A.IMAGE_FOLDER if with_images else A.DOCUMENT_FOLDER
    got = A.asset_downloads(pages_df, assets_df, kind, max_documents if kind == "documents" else max_images, run_ts, folder, max_documents)
    file = F.struct("pos", F.col("asset_url").alias("url"), F.col("relative_path").alias("relativePath"),
                    F.col("file_name").alias("fileName"), F.col("mime_type").alias("mimeType"))
    names = {"images": "imageFiles", "documents": "documentFiles"}
    kinds = list(names) if kind == "all" else [kind]
    per = got.groupBy("page_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, file))).alias(names[k]) for k in kinds])
    out = out.join(per, "page_id", "left")
    return out.withColumns({names[k]: F.transform(names[k], lambda d: d.dropFields("pos")) for k in kinds})
