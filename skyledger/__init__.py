"""Spatio-temporal asset catalogs as Spark tables."""

from skyledger.functions.geometry import geojson_to_wkt, make_envelope, wkt_to_geojson
from skyledger.operators.crawl import crawl, crawl_order, cycles, explode_features, inherit_ids, missing_targets, reach
from skyledger.operators.items import items, require_fields
from skyledger.operators.links import explode_links
from skyledger.operators.pages import follow_pages, matched_audit
from skyledger.operators.schema import infer_schema, merge_schema, property_names, property_types
from skyledger.operators.search import number_pages, render_requests, search, search_batch
from skyledger.plans.read import read, read_catalog, store_items
from skyledger.sources.documents import read_documents, validate, with_kind
from skyledger.sources.responses import freshest_response, read_responses, response_documents
from skyledger.types import ASSET, BBOX, LINK

__all__ = [
    "ASSET", "BBOX", "LINK", "crawl", "crawl_order", "cycles", "explode_features", "explode_links", "follow_pages",
    "freshest_response", "geojson_to_wkt", "infer_schema", "inherit_ids", "items", "make_envelope", "matched_audit",
    "merge_schema", "missing_targets", "number_pages", "property_names", "property_types", "reach", "read", "read_catalog", "read_documents",
    "read_responses", "render_requests", "require_fields", "response_documents", "search", "search_batch", "store_items",
    "validate", "with_kind", "wkt_to_geojson",
]
