"""Names, thresholds and texts that results must carry exactly."""

# Promotion classes by lever mask (feature=4, display=2, tpr=1).
PROMO_BY_MASK = (
    "NONE",
    "TPR_ONLY",
    "DISPLAY_ONLY",
    "DISPLAY_TPR",
    "FEATURE_ONLY",
    "FEATURE_TPR",
    "FEATURE_DISPLAY",
    "COMBINED",
)
SEASONS = ("Winter", "Spring", "Summer", "Fall")
HOLIDAY_MONTHS = (11, 12)

CATEGORY_CODES = {
    "BAG SNACKS": "SNCK",
    "COLD CEREAL": "CERL",
    "FROZEN PIZZA": "PZZA",
    "ORAL HYGIENE PRODUCTS": "ORAL",
}
CATEGORY_CODE_OTHER = "OTHR"
PRIORITY_CATEGORIES = ("COLD CEREAL", "BAG SNACKS")

SIZE_EDGES, SIZE_BANDS = (40000, 60000), ("Small", "Medium", "Large")
PARKING_EDGES, PARKING_BANDS = (300, 500), ("Low", "Medium", "High")
UNKNOWN = "Unknown"

GRADE_EDGES = (0.1, 0.5)
GRADES = ("PASS (< 0.1% issues)", "WARN (< 0.5% issues)", "FAIL (>= 0.5% issues)")

ABC_CUTS, ABC_CLASSES = (0.70, 0.90), ("A", "B", "C")
PARETO_CUTS = (0.80, 0.95)
PARETO_CLASSES = (
    "TOP 80% (Core SKU)",
    "NEXT 15% (Secondary)",
    "TAIL 5% (Candidate for rationalization)",
)
ABC_STRATEGY = {
    "A": "High Value — Protect & Invest",
    "B": "Mid Value — Optimize",
    "C": "Low Value — Review",
}
ABC_ACTION = {
    "A": "🏆 Core SKUs — Ensure availability, protect shelf space, premium promotion",
    "B": "📊 Secondary SKUs — Optimize pricing, selective promotion support",
    "C": "🔍 Tail SKUs — Review for range rationalization or exit",
}

ROLLUP_ALL = ("ALL CATEGORIES", "ALL SUB-CATEGORIES", "ALL PRODUCTS")
NO_FACTS = "NO TRANSACTIONS"
PERIODS = ("PROMOTED", "BASELINE")

TREND_GROWING, TREND_DECLINING, TREND_STABLE = "▲ GROWING", "▼ DECLINING", "─ STABLE"
CATEGORY_ROLES = {1: "PRIMARY CATEGORY", 2: "SECONDARY", 3: "TERTIARY"}
CATEGORY_ROLE_OTHER = "TAIL"

PRICE_BAND_EDGES = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0)
PRICE_BANDS = (
    "Under $1.00",
    "$1.00 – $1.49",
    "$1.50 – $1.99",
    "$2.00 – $2.49",
    "$2.50 – $2.99",
    "$3.00 – $3.49",
    "$3.50 – $3.99",
    "$4.00 – $4.99",
    "$5.00 – $5.99",
    "$6.00+",
)
DISCOUNT_EDGES = (0, 5, 10, 15, 20, 30)
DISCOUNT_ABOVE_BASE = "<0% (above base)"
DISCOUNT_BUCKETS = (
    "0% (No discount)",
    "0.1% – 5%",
    "5.1% – 10%",
    "10.1% – 15%",
    "15.1% – 20%",
    "20.1% – 30%",
    "30%+ (Deep discount)",
)
TIER_EDGES = (10, 20)
TIER_BASELINE = "Baseline (0%)"
TIERS = ("Shallow (1–10%)", "Moderate (11–20%)", "Deep (21%+)")
ELASTIC, INELASTIC = "ELASTIC (price sensitive)", "INELASTIC (price insensitive)"

DEPENDENCY_CUT = 40
DEPENDENCY_HIGH, DEPENDENCY_OK = "⚠️ HIGH PROMO DEPENDENCY", "✓ HEALTHY"

QUINTILES = {
    1: "Q1 — VERY HIGH",
    2: "Q2 — HIGH",
    3: "Q3 — MEDIUM",
    4: "Q4 — LOW",
    5: "Q5 — VERY LOW",
}
FREQUENCY_EDGES = (1.1, 1.5, 2.0)
FREQUENCY_BANDS = (
    "Low (< 1.1 visits/HH)",
    "Medium (1.1–1.5)",
    "High (1.5–2.0)",
    "Very High (2.0+)",
)
REACH_MATRIX = {
    (True, True): "High Reach × High Frequency (STAR)",
    (True, False): "High Reach × Low Frequency (DESTINATION)",
    (False, True): "Low Reach × High Frequency (LOYAL NICHE)",
    (False, False): "Low Reach × Low Frequency (OPPORTUNITY)",
}

ANOMALY_Z = 2
ANOMALY, NORMAL = "⚠️ ANOMALY", "✓ NORMAL"
ABOVE_MA, BELOW_MA = "Above MA", "Below MA"
STORE_TIERS = {
    1: "Tier 1 — Top Performer",
    2: "Tier 2 — Above Average",
    3: "Tier 3 — Below Average",
    4: "Tier 4 — Low Performer",
}
MEDALS = {1: "🥇", 2: "🥈", 3: "🥉"}
STANDINGS = {1: "🏆 State Champion", 2: "🥈 Runner-Up", 3: "🥉 Third Place"}
STANDING_OTHER = "Ranked "
SHIFT_NEW, SHIFT_UP, SHIFT_DOWN, SHIFT_SAME = "🆕 NEW ENTRY", "▲ RISING", "▼ FALLING", "─ STABLE"

PROMO_LEVEL_EDGES = (15, 35)
PROMO_LEVELS = ("LOW PROMO", "MEDIUM PROMO", "HIGH PROMO")
STRATEGIC_CELLS = {
    ("A", "LOW PROMO"): "🟢 Premium Core — Protect Margin",
    ("A", "MEDIUM PROMO"): "🟡 Growth Hero — Moderate Promo",
    ("A", "HIGH PROMO"): "🟠 Promotional Hero — Manage Dependency",
    ("B", "LOW PROMO"): "🔵 Steady Earner — Maintain",
    ("B", "MEDIUM PROMO"): "🔵 Active Secondary — Optimize",
    ("B", "HIGH PROMO"): "🟡 Promo-Dependent B — Watch",
    ("C", "LOW PROMO"): "⚪ Niche/Low-Volume — Review Range",
    ("C", "MEDIUM PROMO"): "🔴 Low Value, Moderate Promo — Exit Candidate",
    ("C", "HIGH PROMO"): "🔴 Promotional Drain — Delisting Candidate",
}
STORE_QUADRANTS = {
    (True, True): "⭐ STAR — High Revenue, High Basket",
    (True, False): "🔼 VOLUME — High Revenue, Low Basket",
    (False, True): "💎 PREMIUM NICHE — Low Revenue, High Basket",
    (False, False): "⚠️ LAGGARD — Low Revenue, Low Basket",
}
LIFECYCLE_GROWTH_ABOVE, LIFECYCLE_MATURE_FROM = 5, -2
LIFECYCLE = (
    ("📈 GROWTH", "Invest in distribution and new SKUs"),
    ("📊 MATURE", "Optimize assortment and margin"),
    ("📉 DECLINE", "Range rationalization and exit review"),
)
CONSISTENCY_EDGES = (5, 15)
CONSISTENCY = (
    "LOW VARIATION — Consistent pricing",
    "MEDIUM VARIATION — Some inconsistency",
    "HIGH VARIATION — Pricing review needed",
)
PRICE_TIER_EDGES = (2.0, 4.0, 6.0)
PRICE_TIERS = ("Budget", "Mid-Tier", "Premium", "Super Premium")
HH_VALUE = {
    1: "HIGH VALUE HH — Loyalty candidates",
    2: "MID-HIGH VALUE HH — Upsell targets",
    3: "MID-LOW VALUE HH — Activation needed",
    4: "LOW VALUE HH — Lapsed or occasional buyers",
}

CHAMPION_PROMO_CUT = 30
CHAMPIONS = (
    "🏆 TRUE CHAMPION — High baseline, low promo need",
    "🎯 PROMO CHAMPION — Only shines during deals",
    "💎 SLEEPER — Good baseline, low total volume",
    "⚠️ STRUGGLER — Below average on both dimensions",
)
PERFORMANCE_FLAGS = ("🟢 Outperformer (+20%+)", "🟡 On Track (±20%)", "🔴 Underperformer (-20%+)")
COHORTS = ("EARLY COHORT", "LATER COHORT")
ROI_POSITIVE = "✅ POSITIVE ROI"
ROI_NEGATIVE = "❌ NEGATIVE ROI — Discount costs exceed incremental revenue"
DEAD_ZONE = "⚠️ DEAD ZONE — 3+ Quarters Flat/Declining"

DASHBOARD_LABELS = {
    "total_revenue": "💰 Total Revenue",
    "total_units": "📦 Total Units",
    "total_visits": "🛒 Total Visits",
    "total_hhs": "🏠 Total Households",
    "total_stores": "🏪 Stores",
    "total_products": "🏷️ Products",
    "total_weeks": "📅 Weeks of Data",
    "avg_basket_value": "🧺 Avg Basket Value ($)",
    "avg_basket_size": "📊 Avg Basket Size (units)",
    "avg_revenue_per_hh": "👤 Avg Revenue per HH ($)",
    "avg_selling_price": "🏷️ Avg Selling Price ($)",
    "avg_discount_pct": "🎯 Avg Discount (%)",
    "promo_rate_pct": "📣 Promo Rate (%)",
    "feature_rate_pct": "📰 Feature Rate (%)",
    "display_rate_pct": "🖼️ Display Rate (%)",
    "tpr_rate_pct": "💸 TPR Rate (%)",
    "yoy_revenue_growth_pct": "📈 YoY Revenue Growth (%)",
    "best_category": "🥇 Best Category",
    "best_product": "🥇 Best Product",
    "best_store": "🥇 Best Store",
    "best_state": "🥇 Best State",
}

CATEGORY_STRATEGY = {
    1: "📈 Portfolio Driver — Protect + Invest",
    2: "📊 Core Category — Optimize & Maintain",
    3: "💡 Growth Opportunity — Promo & Expand",
}
CATEGORY_STRATEGY_OTHER = "🔍 Niche — Review Assortment"
PRICING_HEALTH_EDGES = (3, 8)
PRICING_HEALTH = (
    "LOW DISCOUNT CATEGORY — Price integrity maintained",
    "MODERATE DISCOUNT — Typical retail positioning",
    "HIGH DISCOUNT CATEGORY — Risk of price anchor erosion",
)
REPORT_BAND_EDGES = (2.0, 3.0, 4.0, 5.0)
REPORT_BANDS = ("Under $2.00", "$2.00–$2.99", "$3.00–$3.99", "$4.00–$4.99", "$5.00+")
EFFECTIVENESS = {1: "🥇 Most Effective Promo Type", 2: "🥈 Second Best", 3: "🥉 Third Best"}
EFFECTIVENESS_OTHER = "Lower Tier"
PROMO_HEALTH_EDGES = (0.25, 0.40)
PROMO_HEALTH = (
    "✅ HEALTHY — Strong baseline performance",
    "🟡 MODERATE — Monitor promo frequency",
    "⚠️ HIGH PROMO DEPENDENCY — Brand dilution risk",
)
SEGMENT_INSIGHT = {
    "UPSCALE": "💎 Premium segment — high basket, lower promo sensitivity",
    "MAINSTREAM": "📊 Core segment — balanced performance",
    "VALUE": "💸 Value segment — higher promo dependency, lower basket",
}
REPORT_FREQUENCY_EDGES = (1.1, 1.3)
REPORT_FREQUENCY = (
    "🛒 LOW FREQUENCY — Occasional / infrequent purchase",
    "📈 MODERATE FREQUENCY — Active buyers",
    "🔄 HIGH FREQUENCY — Habitual repurchase category",
)
ERROR_BUCKET_EDGES = (0, 10, 20, 30)
ERROR_BUCKETS = ("0%", "0-10%", "10-20%", "20-30%", "30%+")
RISK_LEVELS = ("Low", "Medium", "High")
RISK_DISCOUNT, RISK_SPIKE, RISK_CATEGORY = 30, 2, "COLD CEREAL"
DISCOUNT_ZONE_EDGES = (10, 15)
DISCOUNT_ZONES = ("Low Impact Zone", "Transition Zone", "Positive Zone")
PROMO_SCENARIOS = (
    ("no promo", 0, 0, 0),
    ("tpr only", 0, 0, 1),
    ("display only", 0, 1, 0),
    ("feature only", 1, 0, 0),
    ("feature + display", 1, 1, 0),
    ("feature + tpr", 1, 0, 1),
    ("display + tpr", 0, 1, 1),
    ("all promo", 1, 1, 1),
)
PRICE_CHANGES = (-5, 0, 5, 10, 15, 20, 25, 30)
CLUSTER_STRATEGY = ("Premium Store", "Price Sensitive Store")
