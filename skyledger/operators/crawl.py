"""Following links from a root document: which documents are reached, with which inherited ids, in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.json import lenient, text_of
from skyledger.operators.links import container_nodes
from skyledger.operators.pages import follow_chain, one_document_each
from skyledger.sources.documents import document_problem
from skyledger.workspace import Workspace

# Links of a page come after its features: feature positions stay below this, link positions start here.
LINKS_AFTER_FEATURES = 1 << 32

# A reached document. catalog and collection are what it inherits; ancestors are the documents on the way to it.
TARGET = (
    "doc_uri string, catalog string, collection string, page_pos bigint, dfs_path array<bigint>, "
    "sampled boolean, ancestors array<string>, parent_uri string"
)


def _roots(documents: DataFrame, root_uris) -> DataFrame:
    roots = [root_uris] if isinstance(root_uris, str) else list(root_uris)
    if not roots or not all(roots):
        raise ValueError("the address of the root document is empty")
    rows = [(u, None, None, 0, [i] if len(roots) > 1 else [], True, [], None) for i, u in enumerate(roots)]
    return documents.sparkSession.createDataFrame(rows, TARGET)


def passed_on() -> tuple[Column, Column]:
    """Catalog and collection that a document's children inherit, from what it inherits, its kind and its id."""
    catalog = F.when(F.col("kind") == "Catalog", F.coalesce("own_id", "catalog")).otherwise(F.col("catalog"))
    collection = F.when(F.col("kind") == "Collection", F.coalesce("own_id", "collection")).otherwise(F.col("collection"))
    return catalog, collection


def _opened(targets: DataFrame, containers: DataFrame, links: str) -> DataFrame:
    """Targets that are containers, with one column of the container table and the ids their children inherit."""
    opened = targets.join(containers.select("doc_uri", "kind", "own_id", links), "doc_uri")
    catalog, collection = passed_on()
    return opened.withColumns({"catalog": catalog, "collection": collection})


def _followed(opened: DataFrame, links: str) -> tuple[DataFrame, Column]:
    """The links of opened targets, and whether one leads back to an ancestor."""
    first_item = F.get(links, F.lit(0))["pos"]
    rows = opened.select("*", F.concat("ancestors", F.array("doc_uri")).alias("way"), first_item.alias("first"), F.explode(links).alias("l"))
    return rows, F.array_contains("way", F.col("l.dst"))


def _children(opened: DataFrame, links: str) -> DataFrame:
    rows, back = _followed(opened, links)
    return rows.where(~back).select(
        F.col("l.dst").alias("doc_uri"), "catalog", "collection", "page_pos",
        F.concat("dfs_path", F.array(F.col("l.pos") + LINKS_AFTER_FEATURES)).alias("dfs_path"),
        (F.col("sampled") & ((F.col("l.rel") != "item") | (F.col("l.pos") == F.col("first")))).alias("sampled"),
        F.col("way").alias("ancestors"), F.col("doc_uri").alias("parent_uri"),
    )


class Closure:
    """All documents reached from the roots: catalogs and collections level by level, then the items they link, then the chains of
    next pages by pointer jumping, until nothing new is found.

    Only the narrow container table takes part in the walk, and of it only the links in question: the item links are read and
    joined once, after the walk through the catalogs. Each step is written before the next begins. A document that child links reach
    on several ways counts once for each pair of ids that it passes on, so each catalog of a mesh is opened once; an item counts once
    for each link to it. A link back to one of its own ancestors is not followed.
    """

    def __init__(self, documents: DataFrame, root_uris, follow_next: bool = True, on_missing: str = "drop"):
        if on_missing not in ("fail", "drop"):
            raise ValueError("on_missing must be 'fail' or 'drop'")
        self.documents = documents
        self.work = work = Workspace(documents.sparkSession)
        self.schema = documents.sparkSession.createDataFrame([], TARGET).schema
        self.containers, counts = work.materialize(
            container_nodes(documents), "containers", n_paged=F.count_if(F.col("next_uri").isNotNull()),
            n_children=F.count_if(F.size("child_links") > 0), n_items=F.count_if(F.size("item_links") > 0),
        )
        one_document_each(self.containers, "doc_uri")
        path, _ = work.write(_roots(documents, root_uris), "level-0")
        self.opened: list[str] = []
        paths, unopened = [path], [(path, "roots")]
        while unopened:
            path, origin = unopened.pop(0)
            found = self._descend(path) if counts["n_children"] else []
            paths += found
            tree = [path, *found]
            if counts["n_items"]:
                path, n = self._step(_children(self._open(tree, "item_links"), "item_links"))
                if n:
                    paths.append(path)
                    # a link called item may lead to a container all the same
                    odd, n = self._step(work.read(self.schema, path).join(self.containers.select("doc_uri"), "doc_uri", "left_semi"))
                    unopened += [(odd, "items")] if n else []
            # the next links of later pages are part of the chain that led to them
            heads = tree[1:] if origin == "pages" else tree
            if follow_next and counts["n_paged"] and heads:
                path, n = self._step(self._next_pages(self._open(heads, "next_uri").where("next_uri IS NOT NULL")))
                if n:
                    paths.append(path)
                    unopened.append((path, "pages"))
        self.targets = work.read(self.schema, *paths)
        lost = self.missing().first() if on_missing == "fail" else None
        if lost is not None:
            raise FileNotFoundError(f"no document '{lost['doc_uri']}', linked from '{lost['parent_uri']}'")

    def _step(self, df: DataFrame) -> tuple[str, int]:
        self.n_steps = getattr(self, "n_steps", 0) + 1
        path, n = self.work.write(df.select(self.schema.names), f"step-{self.n_steps}")
        return path, n["n_rows"]

    def _open(self, paths: list[str], links: str) -> DataFrame:
        return _opened(self.work.read(self.schema, *paths), self.containers, links)

    def _descend(self, path: str) -> list[str]:
        """Tables of what child links lead to from here, one per level."""
        found = []
        self.opened.append(path)
        while True:
            path, n = self._step(self._first_time(_children(self._open([path], "child_links"), "child_links")))
            if not n:
                return found
            found.append(path)
            self.opened.append(path)

    def _passed_on(self, rows: DataFrame) -> DataFrame:
        """Add the address and the ids that a document passes on, with NULL told from ''."""
        nodes = self.containers.select(F.col("doc_uri").alias("_doc_uri"), "kind", "own_id")
        known = rows.join(nodes, F.col("doc_uri") == F.col("_doc_uri"), "left").drop("_doc_uri")
        catalog, collection = passed_on()
        ids = [F.struct(c.isNull(), F.coalesce(c, F.lit(""))) for c in (catalog, collection)]
        return known.select(*self.schema.names, F.struct("doc_uri", *ids).alias("_state"))

    def _first_time(self, rows: DataFrame) -> DataFrame:
        """Of what child links lead to, what was not reached before passing on the same ids; of several ways in one level the first in document order."""
        first = self._passed_on(rows).groupBy("_state").agg(
            F.min_by(F.struct(*self.schema.names), F.struct("page_pos", "dfs_path")).alias("t"), F.max("sampled").alias("_sampled")
        )
        seen = self._passed_on(self.work.read(self.schema, *self.opened)).select("_state").distinct()
        fresh = first.join(seen, "_state", "left_anti")
        return fresh.select(*[F.col("_sampled").alias(c) if c == "sampled" else F.col(f"t.{c}").alias(c) for c in self.schema.names])

    def _next_pages(self, heads: DataFrame) -> DataFrame:
        starts = heads.select(
            F.col("doc_uri").alias("node"), "catalog", "collection", "page_pos", "dfs_path", "ancestors",
            F.col("doc_uri").alias("head_uri"),
        )
        edges = self.containers.where("next_uri IS NOT NULL").select(
            F.col("doc_uri").alias("src"), F.col("next_uri").alias("dst")
        )
        chain = follow_chain(starts, edges, Workspace(self.documents.sparkSession)).where("pos > 0")
        return chain.select(
            F.col("node").alias("doc_uri"), "catalog", "collection", (F.col("page_pos") + F.col("pos")).alias("page_pos"),
            "dfs_path", F.lit(False).alias("sampled"),
            F.concat("ancestors", F.array("head_uri")).alias("ancestors"), F.col("head_uri").alias("parent_uri"),
        )

    def back_links(self) -> DataFrame:
        """Links that lead back to an ancestor and were not followed."""
        parts = []
        for links in ("child_links", "item_links"):
            rows, back = _followed(_opened(self.targets, self.containers, links), links)
            parts.append(rows.where(back).select("doc_uri", F.col("l.dst").alias("target_uri"), "dfs_path"))
        return parts[0].unionByName(parts[1])

    def missing(self) -> DataFrame:
        """Reached addresses without a document."""
        return self.targets.join(self.documents.select("doc_uri"), "doc_uri", "left_anti").select("doc_uri", "parent_uri")


def reach(documents: DataFrame, root_uris, follow_next: bool = True) -> DataFrame:
    """Every document reached from the roots: (doc_uri, catalog, collection, page_pos, dfs_path, sampled, parent_uri)."""
    return Closure(documents, root_uris, follow_next).targets.drop("ancestors")


def cycles(documents: DataFrame, root_uris) -> DataFrame:
    """Links that lead back to an ancestor: (doc_uri, target_uri, dfs_path)."""
    return Closure(documents, root_uris, follow_next=False).back_links()


def missing_targets(documents: DataFrame, root_uris) -> DataFrame:
    return Closure(documents, root_uris).missing()


def explode_features(documents: DataFrame) -> DataFrame:
    """Features of item and page documents: (doc_uri, feature_pos, feature). Members of ``features`` that are no objects are skipped."""
    return features_of(documents).where("feature IS NOT NULL").select("doc_uri", "feature_pos", "feature")


def features_of(documents: DataFrame) -> DataFrame:
    """At least one row per document; ``feature`` is NULL where a document holds none. ``problem`` says why it cannot be read."""
    parsed = lenient(documents).select("doc_uri", "body", F.from_json("body", "type VARIANT, features ARRAY<STRING>").alias("d"))
    kind = text_of(F.col("d.type"))
    parts = F.when(kind == "Feature", F.array("body")).when(kind == "FeatureCollection", F.col("d.features"))
    first = F.array_position(F.transform("d.features", lambda f: f.startswith("{")), True) - 1
    # the costly check runs only where no type was found
    problem = F.when(F.coalesce(kind, F.lit("")) == "", document_problem(F.col("body")))
    rows = parsed.select("doc_uri", kind.alias("kind"), problem.alias("problem"), first.alias("first_feature_pos"), F.posexplode_outer(parts).alias("pos", "text"))
    return rows.select(
        "doc_uri", "problem", "first_feature_pos",
        F.when(F.col("kind") == "FeatureCollection", F.col("pos").cast("bigint")).alias("feature_pos"),
        F.when((F.col("kind") == "Feature") | F.col("text").startswith("{"), F.col("text")).alias("feature"),
    )


def crawl(documents: DataFrame, root_uris, on_missing: str = "fail", on_error: str = "fail") -> DataFrame:
    """Items reached from the roots, not yet shaped.

    (catalog, collection, page_pos, dfs_path, doc_uri, sampled, feature); catalog and collection are the inherited ids.
    A link to a document that is not there raises, or is passed over when ``on_missing`` is ``drop``.
    """
    return attach(features_of(documents), Closure(documents, root_uris, on_missing=on_missing).targets, on_error)


def attach(features: DataFrame, targets: DataFrame, on_error: str = "fail") -> DataFrame:
    """Give features (doc_uri, problem, first_feature_pos, feature_pos, feature, ...) the ids and the place of the reached
    document they stand in. Columns derived from the feature before this join travel instead of its text.

    A reached document that cannot be read raises when its row is read, or is passed over when ``on_error`` is ``drop``.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    # tested before the join, so that the text stays behind when nothing else needs it
    features = features.withColumn("_is_item", F.col("feature").isNotNull())
    joined = targets.drop("ancestors").join(features, "doc_uri")
    is_item = F.col("_is_item")
    if on_error == "fail":
        # naming the parent keeps the test above the join, where documents that are not reached are gone
        failed = F.raise_error(F.format_string("%s in the document '%s', linked from '%s'", "problem", "doc_uri", "parent_uri"))
        is_item = F.when(F.col("problem").isNotNull(), failed.cast("boolean")).otherwise(is_item)
    joined = joined.where(is_item)
    is_first = F.col("feature_pos").isNull() | (F.col("feature_pos") == F.col("first_feature_pos"))
    path = F.when(F.col("feature_pos").isNull(), F.col("dfs_path")).otherwise(F.concat("dfs_path", F.array("feature_pos")))
    own = ("doc_uri", "problem", "feature_pos", "feature", "first_feature_pos", "_is_item")
    extra = [c for c in features.columns if c not in own]
    return joined.select(
        "catalog", "collection", "page_pos", path.alias("dfs_path"), "doc_uri",
        (F.col("sampled") & is_first).alias("sampled"), "feature", *extra,
    )


def crawl_order(items: DataFrame) -> DataFrame:
    """Document order: whole first read depth first, links in array order, a page's features before its links; then page by page."""
    return items.orderBy("page_pos", "dfs_path")


def inherit_ids(items_raw: DataFrame) -> DataFrame:
    """Resolve the ids of each item: its own ``collection`` wins over the inherited one; '' when there is none."""
    own = text_of(F.from_json("feature", "collection VARIANT")["collection"])
    return lenient(items_raw).withColumns(inherited(own))


def inherited(own: Column) -> dict[str, Column]:
    return {
        "catalog": F.coalesce("catalog", F.lit("")),
        "collection": F.coalesce(own, F.col("collection"), F.lit("")),
    }
