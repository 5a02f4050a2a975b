"""Record types, vocabularies and constraints of the catalog."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
MARKETS = ["RO", "DE", "IT", "ES", "BG", "FR", "BE", "AT", "PT", "HU", "PL"]
UNITS = ["g", "kg", "ml", "l", "buc"]
CATEGORIES = ["produce", "dairy", "bakery", "meat", "fish", "pantry", "frozen", "snacks", "drinks", "alcohol", "baby", "household", "personal-care", "health", "pet", "home", "other"]
RUN_STATUSES = ["running", "completed", "partial", "failed"]
LOG_LEVELS = ["info", "warn", "error"]
IDENTIFIER_TYPES = ["gtin", "mpn"]

PRICE, SIZE = T.DecimalType(12, 2), T.DecimalType(18, 3)

#: What every reader makes and everything downstream takes.
IMPORT_ROW = "external_id string, name string, brand string, gtin string, price decimal(12,2), currency string, quantity decimal(18,3), unit string, category string, product_url string, available boolean"
#: A product as a shop shows it, before validation.
PRODUCT_RECORD = "external_id string, name string, brand string, gtin string, price double, currency string, quantity double, unit string, category string, product_url string, available boolean"
PRODUCT = "product_id string, canonical_name string, brand string, quantity decimal(18,3), quantity_unit string, category string, add_count long, first_seen_at timestamp"
IDENTIFIER = "product_id string, identifier_type string, identifier_value string, source string"
LISTING = "product_id string, retailer string, external_id string, retailer_name string, retailer_brand string, retailer_category string, price decimal(12,2), currency string, available boolean, product_url string, previous_price decimal(12,2), last_price_at timestamp, first_seen_at timestamp, last_seen_at timestamp"
RUN = "run_id string, retailer string, status string, started_at timestamp, finished_at timestamp, products_found long, products_valid long, marked_unavailable long, error string"

#: By table: name of the constraint and the condition that holds (null counts as holding).
CONSTRAINTS = {
    "product": {
        "name_length": "length(canonical_name) between 1 and 200",
        "brand_length": "length(brand) <= 80",
        "size_complete": "(quantity is null) = (quantity_unit is null)",
        "size_range": "quantity > 0 and quantity <= 1000000",
        "unit_known": f"quantity_unit in ({', '.join(map(repr, UNITS))})",
        "category_known": f"category in ({', '.join(map(repr, CATEGORIES))})",
        "key_length": "length(merge_key) <= 500",
    },
    "listing": {
        "name_length": "length(retailer_name) between 1 and 300",
        "external_id_length": "length(external_id) between 1 and 100",
        "price_range": "price between 0 and 1000000",
        "currency_shape": "currency rlike '^[A-Z]{3}$'",
        "currency_given": "price is null or currency is not null",
        "url_https": "product_url like 'https://%' and length(product_url) <= 1000",
    },
    "identifier": {
        "type_known": f"identifier_type in ({', '.join(map(repr, IDENTIFIER_TYPES))})",
        "value_shape": "case identifier_type when 'gtin' then identifier_value rlike '^[0-9]{8,14}$' else length(identifier_value) between 1 and 60 end",
    },
    "run": {"status_known": f"status in ({', '.join(map(repr, RUN_STATUSES))})", "counts_positive": "products_found >= 0 and products_valid >= 0"},
}
#: By table: columns of which each combination occurs once.
UNIQUE = {"product": [["merge_key"]], "identifier": [["identifier_type", "identifier_value"]], "listing": [["retailer", "external_id"]], "retailer": [["slug"]]}
