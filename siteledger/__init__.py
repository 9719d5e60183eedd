"""siteledger: web-site inventories, link graphs and accessibility records on Spark.

Operators take and return DataFrames and can be chained with ``df.transform(fn, ...)``.
"""

from siteledger.operators.batching import batch_rows, with_row_index
from siteledger.operators.crawl import crawl
from siteledger.operators.dedupe import keep_first, keep_first_except, latest_per_key
from siteledger.operators.events import from_events, to_messages
from siteledger.operators.filters import exclude_terms, exclude_urls, keep_tlds, keep_type
from siteledger.operators.hosts import default_suffixes, split_host
from siteledger.operators.links import extract_links, link_messages, page_links, unseen_links
from siteledger.operators.records import accessible_share, daily_shares, latest_records, retain
from siteledger.operators.rename import AgencyRule, OrgRule, rename_by_rules
from siteledger.operators.routes import attach_routes, reachable, resolve_routes, url_candidates
from siteledger.operators.scan import explode_issues, scan_pages, scan_records
from siteledger.operators.tree_scan import scan_trees
from siteledger.plans.dispatch import dispatch
from siteledger.plans.inventory import build_inventory, merge_registry_sites
from siteledger.plans.results import backfill_history, join_results, scan_sites
from siteledger.plans.site_map import map_links
from siteledger.sources.files import first_file, list_files
from siteledger.sources.history import (
    append_history,
    read_history,
    read_history_file,
    write_history_file,
)
from siteledger.sources.lists import (
    read_inventory,
    read_registry,
    read_seed_sites,
    read_suffixes,
    rejected_rows,
    write_inventory,
)
from siteledger.sources.messages import batches_to_events, read_events, write_batches
from siteledger.sources.pages import pages_of, read_pages, write_pages
from siteledger.sources.records import (
    read_record_files,
    read_records,
    write_record_files,
    write_records,
)
from siteledger.sources.removal import expired_folders, remove_planned
from siteledger.sources.versions import forget_versions, read_version, versions, write_version
from siteledger.streaming.events import read_dead_letters, route_bad_messages, stream_events
from siteledger.streaming.folders import read_folders, upsert_folders
from siteledger.streaming.receives import consume_counted, count_receives, read_counted
from siteledger.streaming.state import compact, consume, read_latest, snapshot, upsert_latest
