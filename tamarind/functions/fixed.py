"""Lookup tables, labels and bounds that results depend on.

These are data, not logic. They are listed in their natural order so they can
be checked by eye against the marketplace's published definitions.
"""

# Accented letters and the plain letters that replace them.
ACCENTED = "àáâãéêíóôõúç"
PLAIN = "aaaaeeiooouc"

# Bounding box of the country, in degrees.
LAT_MIN, LAT_MAX = -34.0, 6.0
LNG_MIN, LNG_MAX = -75.0, -28.0

# State code to macro-region.
STATE_REGION = {
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast",
    "PR": "South", "SC": "South", "RS": "South",
    "GO": "Central-West", "MT": "Central-West", "MS": "Central-West", "DF": "Central-West",
    "BA": "Northeast", "PE": "Northeast", "CE": "Northeast", "PB": "Northeast", "RN": "Northeast",
    "AL": "Northeast", "SE": "Northeast", "PI": "Northeast", "MA": "Northeast",
    "AM": "North", "PA": "North", "AC": "North", "RO": "North", "RR": "North", "AP": "North", "TO": "North",
}

# State code to full name.
STATE_NAME = {
    "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapá", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MG": "Minas Gerais", "MS": "Mato Grosso do Sul", "MT": "Mato Grosso",
    "PA": "Pará", "PB": "Paraíba", "PE": "Pernambuco", "PI": "Piauí", "PR": "Paraná",
    "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte", "RO": "Rondônia", "RR": "Roraima",
    "RS": "Rio Grande do Sul", "SC": "Santa Catarina", "SE": "Sergipe", "SP": "São Paulo",
    "TO": "Tocantins",
}

# Metropolitan cities (already text-normalised) and urban states.
METRO_CITIES = (
    "sao paulo", "rio de janeiro", "brasilia", "salvador", "fortaleza",
    "belo horizonte", "curitiba", "manaus", "recife", "porto alegre",
)
URBAN_STATES = ("SP", "RJ", "MG")

# Order statuses that mean the order is still on its way.
IN_PROGRESS = ("shipped", "processing", "approved", "created", "invoiced")

# Category names translated by hand, ahead of the lookup table.
CATEGORY_OVERRIDES = {
    "pc_gamer": "pc_gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "kitchen_portables_and_food_preparers",
}

# A review identifier is 32 hexadecimal digits.
HEX_ID = "^[a-fA-F0-9]{32}$"

# Banding rules. Each step is (comparison, bound, label); the
# first step that holds gives the label.
DELIVERY_DETAIL = (
    ("<=", -7, "Very Early"), ("<", 0, "Early"), ("==", 0, "On Time"),
    ("<=", 3, "Slight Delay"), ("<=", 7, "Late"), (">", 7, "Critical Delay"),
)
PRODUCT_SIZE = (("<=", 5000, "Small"), ("<=", 20000, "Medium"), (">", 20000, "Large"))
PARCEL_SIZE = (
    ("<=", 0, "Unknown Size"), ("<=", 5000, "Small Box"),
    ("<=", 20000, "Medium Box"), (">", 20000, "Large Parcel"),
)
PARCEL_WEIGHT = (
    ("<=", 0, "Unknown Weight"), ("<=", 2000, "Lightweight"),
    ("<=", 10000, "Midweight"), (">", 10000, "Heavyweight"),
)
REVIEW_LABEL = ((">=", 4, "Satisfied"), ("==", 3, "Neutral"))
SENTIMENT = ((">=", 4, "Positive"), ("==", 3, "Neutral"))
CONVERSION_SPEED = (
    ("<=", 7, "Fast Conversion"), ("<=", 30, "Normal Conversion"), (">", 30, "Slow Conversion"),
)
WORKLOAD = ((">=", 100, "Overloaded"), (">=", 50, "High Volume"), (">=", 10, "Normal Volume"))
GROWTH = ((">=", 0.50, "High Growth"), (">=", 0.10, "Moderate Growth"), ("<=", -0.10, "Declining"))
ON_TIME_GRADE = ((">=", 0.90, "Excellent"), (">=", 0.75, "Good"), (">=", 0.50, "Fair"))
PRICE_BUCKET = (
    ("<", 50, "Under R$50"), ("<", 100, "R$50-100"), ("<", 200, "R$100-200"),
    ("<", 400, "R$200-400"), (">=", 400, "Above R$400"),
)
FREIGHT_BUCKET = (
    ("<", 15, "Under R$15"), ("<", 30, "R$15-30"), ("<", 50, "R$30-50"), (">=", 50, "Above R$50"),
)
LOYALTY = (("==", 1, "New"), ("<=", 4, "Repeat"))
SELLER_SIZE = (("<", 50, "Small Seller"), ("<=", 500, "Medium Seller"), (">", 500, "Large Seller"))

# Other category labels.
PAYMENT_CATEGORY = {"credit_card": "Card", "debit_card": "Card", "boleto": "Boleto", "voucher": "Voucher"}
SENTIMENT_BAND = {"Positive": "Score 4-5", "Neutral": "Score 3", "Negative": "Score 1-2"}
DELIVERY_GROUP = {
    "On Time": "Successful", "Slight Delay": "Delayed", "Late": "Delayed", "Critical Delay": "Delayed",
}

# Order of the lifecycle milestones of an order.
MILESTONES = (
    "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
)
ESTIMATE = "order_estimated_delivery_date"

# Fallbacks in seconds when no complete order exists to learn from
# (purchase to approval, approval to carrier, carrier to customer, purchase to estimate).
DEFAULT_GAPS = {"approval": 3600, "carrier": 86400, "customer": 259200, "estimate": 950400}
DEFAULT_RESPONSE_SECONDS = 86400
DEFAULT_LIMIT_DAYS = 4

# Reasons of the audit log.
BAD_COORDINATES = "Invalid or missing geolocation coordinates"
CUSTOMER_ZIP = "Customer zip code missing or not found in geolocation"
ORDER_CUSTOMER = "Order customer_id not found in silver_customers"
PRODUCT_FIELDS = "Product missing key logistics fields"
ITEM_ORDER = "Order item order_id missing from silver_orders"
ITEM_LIMIT = "Invalid shipping_limit_date, rebuilt using median approval-to-limit days"
PAYMENT_ORDER = "Payment order_id missing from silver_orders"
REVIEW_KEY = "Review critical key or score missing"
REVIEW_ORDER = "Review order_id missing from silver_orders"
LEAD_ID = "MQL missing mql_id"
DEAL_IDS = "Closed deal missing mql_id or seller_id"
SELLER_ZIP = "Seller zip code missing or not found in geolocation"
ORPHAN_TRANSACTION = "Orphaned Transaction - Missing Order Record in Source"
