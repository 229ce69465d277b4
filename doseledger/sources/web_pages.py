"""Medicine web pages: HTML to sections, and page documents to section rows."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doseledger.functions.casting import blank_list, blank_text
from doseledger.schemas import DRUG_KEY_PATTERN, PAGE_KIND, PAGES_DOC, PAGES_FILE
from doseledger.session import any_file

# Comments, declarations and raw-text elements become one mark that separates texts.
_NOT_CONTENT = (
    r"(?is)<(?:!--.*?-->|(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|![^>]*>|\?[^>]*>)"
)
_TAG = r"""<(/?[a-zA-Z][^\s/>]*+)(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""
_ENTITY = r"&((?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);?)"
# numbers 128 to 159 stand for what they are in Windows-1252
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
_EDGE_SPACE = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_VOID = (
    "area base br col embed hr img input keygen link menuitem meta param source track wbr"
).split()


def drug_key_ok(key: Column) -> Column:
    """Lower-case letters and hyphens, starting and ending with a letter."""
    return F.coalesce(key.rlike(DRUG_KEY_PATTERN), F.lit(False))


def page_type(url: Column) -> Column:
    """Kind of page from the last part of its address."""
    slug = F.substring_index(F.regexp_replace(url, r"/+$", ""), "/", -1)
    return (
        F.when(slug.contains("side-effects"), "side_effects")
        .when(slug.contains("who-can"), "contraindications")
        .otherwise("interactions")
    )


def _decode_entity(body: Column) -> Column:
    """The character an entity stands for, or the entity as written when unknown."""
    named = F.create_map(*[F.lit(v) for pair in html5.items() for v in pair])
    windows = F.create_map(*[F.lit(v) for pair in _WINDOWS.items() for v in pair])
    written, body = body, F.rtrim(body, F.lit(";"))
    hexadecimal = body.rlike("^#[xX]")
    code = F.when(hexadecimal, F.conv(F.substring(body, 3, 8), 16, 10)).when(
        body.startswith("#"), F.substring(body, 2, 8)
    ).cast("bigint")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numeric = F.coalesce(
        F.try_element_at(windows, code.cast("int")), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    )
    return F.when(body.startswith("#"), F.when(valid, numeric).otherwise("�")).otherwise(
        F.coalesce(F.try_element_at(named, written), F.concat(F.lit("&"), written))
    )


def _plain(text: Column) -> Column:
    """Text of one node: entities decoded, outer white space removed."""
    between = F.split(text, _ENTITY, -1)
    decoded = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(1)), _decode_entity)
    joined = F.concat_ws("", F.flatten(F.zip_with(between, decoded, lambda a, b: F.array(a, b))))
    text = F.when(text.contains("&"), joined).otherwise(text)
    return F.regexp_replace(text, "(?U)" + _EDGE_SPACE, "")


_ELEMENT = "struct<first: int, last: int, parent: int, name: string>"
_KEPT = ["main", "p", "li", "ul", "ol", "h2", "h3"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _marks(tags: Column) -> Column:
    """Each tag as its name, with ``/`` before an end tag; empty for tags that hold nothing."""

    def mark(tag):
        name = F.lower(F.regexp_extract(tag, r"^<(/?[^\s/>]+)", 1))
        return F.when(name.isin(_VOID) | tag.endswith("/>"), "").otherwise(name)

    return F.transform(tags, mark)


def _elements(marks: Column) -> Column:
    """Extents of elements, found by matching end tags with the nearest open element.

    ``first`` and ``last`` are positions in the tag list. An end tag closes everything opened
    after its partner; one without a partner is ignored; what stays open ends with the page.
    """
    none = F.array().cast(f"array<{_ELEMENT}>")
    names = F.array().cast("array<string>")
    start = F.struct(
        F.lit(0).alias("at"), names.alias("names"), none.alias("open"), none.alias("done")
    )

    def close(opened, at):
        return F.transform(
            F.filter(opened, lambda o: o["name"].isin(_KEPT)),
            lambda o: F.struct(
                o["first"].alias("first"), at.alias("last"), o["parent"].alias("parent"),
                o["name"].alias("name"),
            ).cast(_ELEMENT),
        )

    def state(at, names, opened, done):
        return F.struct(
            (at + 1).alias("at"), names.alias("names"), opened.alias("open"), done.alias("done")
        )

    def step(s, mark):
        at, names, opened, done = s["at"], s["names"], s["open"], s["done"]
        depth = F.size(opened)
        above = F.coalesce(F.try_element_at(opened, F.greatest(depth, F.lit(1)))["first"], F.lit(-1))
        entry = F.struct(
            at.alias("first"), at.alias("last"), above.alias("parent"), mark.alias("name")
        ).cast(_ELEMENT)
        pushed = state(
            at, F.concat(names, F.array(mark)), F.concat(opened, F.array(entry)), done
        )

        def popped(back):
            # ``back`` counts from the innermost open element; 0 means no partner
            keep = depth - back
            closed = close(F.slice(opened, keep + 1, back), at)
            return F.when(back == 0, state(at, names, opened, done)).otherwise(
                state(
                    at,
                    F.slice(names, 1, keep),
                    F.slice(opened, 1, keep),
                    _let(closed, lambda c: F.when(F.size(c) > 0, F.concat(done, c)).otherwise(done)),
                )
            )

        end = _let(
            F.array_position(F.reverse(names), F.substring(mark, 2, 2**31 - 1)).cast("int"), popped
        )
        return (
            F.when(mark == "", state(at, names, opened, done))
            .when(mark.startswith("/"), end)
            .otherwise(pushed)
        )

    return F.aggregate(
        marks, start, step, lambda s: F.array_sort(F.concat(s["done"], close(s["open"], s["at"])))
    )


def _text_of(texts: Column, element: Column) -> Column:
    inner = F.slice(texts, element["first"] + 2, element["last"] - element["first"])
    return F.array_join(F.filter(inner, lambda t: t != ""), " ")


def _with_sections(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Each page with its sections as one array; see :func:`html_sections`."""
    kept = [c for c in pages.columns if c not in (url, html)]
    clean = F.regexp_replace(F.col(html), _NOT_CONTENT, "<br>")
    split = pages.select(*kept, F.col(url).alias("url"), clean.alias("clean"))
    # each generator below is a step the optimizer does not merge into the next, so that the
    # tokens and extents of a page are computed once
    tokens = split.select(
        *kept,
        "url",
        F.inline(
            F.array(
                F.struct(
                    _marks(F.regexp_extract_all("clean", F.lit(_TAG), F.lit(0))).alias("marks"),
                    F.transform(F.split("clean", _TAG, -1), _plain).alias("texts"),
                )
            )
        ),
    )
    parsed = tokens.select(
        *kept, "url", "texts", F.explode(F.array(_elements(F.col("marks")))).alias("all")
    )
    main = F.try_element_at(F.filter("all", lambda e: e["name"] == "main"), F.lit(1))
    scoped = parsed.select(
        *kept,
        "url",
        "texts",
        F.explode(
            F.array(
                F.filter(
                    "all",
                    lambda e: main.isNull()
                    | ((e["first"] > main["first"]) & (e["first"] < main["last"])),
                )
            )
        ).alias("inside"),
    )
    texts, inside = F.col("texts"), F.col("inside")
    heads = F.filter(inside, lambda e: e["name"].isin("h2", "h3"))

    def section(head):
        next_head = F.coalesce(
            F.array_min(
                F.transform(
                    F.filter(
                        inside,
                        lambda e: e["name"].isin("h2", "h3")
                        & (e["parent"] == head["parent"])
                        & (e["first"] > head["first"]),
                    ),
                    lambda e: e["first"],
                )
            ),
            F.lit(2**31 - 1),
        )

        def until(upto):
            def follows(e):
                return (e["parent"] == head["parent"]) & (e["first"] > head["first"]) & (e["first"] < upto)

            def items(lists):
                found = F.filter(
                    inside,
                    lambda i: (i["name"] == "li")
                    & F.exists(lists, lambda u: (i["first"] > u["first"]) & (i["first"] < u["last"])),
                )
                return F.transform(found, lambda i: _text_of(texts, i))

            lists = F.filter(inside, lambda e: e["name"].isin("ul", "ol") & follows(e))
            paragraphs = F.filter(inside, lambda e: (e["name"] == "p") & follows(e))
            return F.struct(
                _text_of(texts, head).alias("heading"),
                F.array_join(F.transform(paragraphs, lambda p: _text_of(texts, p)), " ").alias("text"),
                _let(lists, items).alias("bullets"),
            )

        # computed once for a heading, not for each element that is compared with it
        return _let(next_head, until)

    whole = F.struct(
        F.lit("").alias("heading"),
        F.array_join(
            F.transform(F.filter(inside, lambda e: e["name"] == "p"), lambda p: _text_of(texts, p)),
            " ",
        ).alias("text"),
        F.transform(
            F.filter(inside, lambda e: e["name"] == "li"), lambda i: _text_of(texts, i)
        ).alias("bullets"),
    )
    sections = F.when(F.size(heads) > 0, F.transform(heads, section)).otherwise(F.array(whole))
    return scoped.select(
        *kept, "url", page_type(F.col("url")).alias("page_type"), sections.alias("sections")
    )


def html_sections(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per heading of each page: url, page_type, pos, heading, text, bullets.

    A section starts at an ``h2`` or ``h3`` inside ``<main>`` (or the page, without one) and takes
    the paragraphs and lists that follow as siblings, up to the next sibling heading. A page
    without headings gives one section of all its paragraphs and list items. Other columns of
    ``pages`` are kept. Everything runs inside the row, so no shuffle is needed.
    """
    kept = [c for c in pages.columns if c not in (url, html)]
    # every page has a section; the outer form only spares a filter that would build them twice
    return (
        _with_sections(pages, url, html)
        .select(*kept, "url", "page_type", F.posexplode_outer("sections").alias("pos", "s"))
        .select(*kept, "url", "page_type", "pos", "s.heading", "s.text", "s.bullets")
    )


def page_documents(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Documents to be written: drug, type and the sections of one page each.

    ``pages`` has a ``drug`` column. A document holds one page, so it is built inside the row and
    stays page-sized, however many pages a medicine has.
    """
    return _with_sections(pages, url, html).select(
        "drug",
        F.lit(PAGE_KIND).alias("type"),
        F.transform(
            "sections",
            lambda s: F.struct(
                F.col("url"),
                F.col("page_type"),
                s["heading"].alias("heading"),
                s["text"].alias("text"),
                s["bullets"].alias("bullets"),
            ),
        ).alias("pages"),
    )


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per section with the contract's defaults."""
    return documents.select("drug", F.inline("pages")).select(
        "drug",
        blank_text(F.col("page_type")).alias("page_type"),
        blank_text(F.col("heading")).alias("heading"),
        blank_text(F.col("text")).alias("text"),
        blank_list(F.col("bullets")).alias("bullets"),
        blank_text(F.col("url")).alias("url"),
    )


def read_sections(spark: SparkSession, base: str, drug: str | None = None) -> DataFrame:
    """Sections of page documents under a lake; the folder names the medicine if a document does not.

    Reads ``<drug>/nhs_pages.json`` (one document per file) and ``drug=<drug>/part-*`` (one
    document per line).
    """
    one = drug or "*"
    parts = []
    if any_file(spark, f"{base}/{one}/{PAGES_FILE}"):
        whole = spark.read.option("multiLine", True).schema(PAGES_DOC).json(f"{base}/{one}/{PAGES_FILE}")
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
        parts.append(whole.withColumn("drug", F.coalesce("drug", folder)))
    if any_file(spark, f"{base}/drug={one}"):
        lines = spark.read.option("basePath", base).schema(PAGES_DOC).json(f"{base}/drug={one}")
        parts.append(lines)
    if not parts:
        raise FileNotFoundError(f"no page documents for {one!r} under {base}")
    documents = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return flatten_documents(documents)
