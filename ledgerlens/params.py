"""Query parameters standing in for the reference's literals (FIXTURES.md section C).

The reference's literals (year 2023, two named stores, thresholds 800 /
10,000 / 600) refer to its own data.  On the driver tables the same queries
run with the values below, chosen so that some rows pass and some fail.
"""

YEAR = 1998                          # for: YEAR(transaction_date) = 2023
NAMED_STORE = "Supplier#000000003"   # for: the store of the top-3 products question
NAMED_TIMED_STORE = "BUILDING"       # for: the store of the busiest-hour question
COMPARE_STORES = ("Supplier#000000001", "Supplier#000000002")
FILTER_STORES = ("Supplier#000000000", "Supplier#000000004", "Supplier#000000007", "BUILDING")
GLOBAL_FILTER_STORES = ("Supplier#000000004", "Supplier#000000007", "Supplier#000000008")
PIVOT_STORES = tuple(f"Supplier#{i:09d}" for i in (3, 0, 7, 1, 9))   # declared pivot columns, in display order
FILTER_PRODUCT = "small ring"
PRODUCT_RISK_THRESHOLD = 1_000_000   # for: total sales below 800 (per product id)
HOUR_RISK_THRESHOLD = 20_000         # for: hours with less than 10,000 total sales
PIVOT_FLAG_THRESHOLD = 30_000        # for: pivot cells highlighted when < 600
LOW_SALES_DAY = 30_000               # count_if predicate over daily rows
GROWTH_FIRST_YEAR = 1995             # first full year of the data
GROWTH_LAST_YEAR = 2000              # last full year of the data
BATCH_RANGE = (3, 7)                 # inclusive batch window of the replay filters
TOP_PRODUCTS = 10
TOP_PER_STORE = 3
TOP_CATEGORIES = 3
RANK_LIMIT = 5
PREVIEW_ROWS = 20
MIXED_LIMIT = 15
PROMPT_LIMIT = 35
HEATMAP_HOURS = (6, 20)
# Custom axis order of a chart (a fixed value list, as in a dashboard spec).
CHART_ORDER = ("red widget", "blue bolt", "small ring", "hot gear", "small gizmo")
REPLAY_RANGE = (11, 15)              # batch window of the date-based replay rules (after the pivot)
