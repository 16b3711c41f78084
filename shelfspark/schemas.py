"""Record layouts between the layers."""

SILVER = (
    "id string, store string, category string, name_en string, name_ar string, brand string, barcodes array<string>, "
    "price double, original_price double, discount_amount double, discount_percentage double, pack_qty int, "
    "unit_size_value double, total_size_value double, size_unit string, image_url string"
)
WEIGHTED = (
    "is_weighted boolean, weighted_interval double, "
    "weighted_options array<struct<quantity_value: double, quantity_name: string, price: double, original_price: double>>"
)
SILVER_WEIGHTED = f"{SILVER}, {WEIGHTED}"

BRONZE_TAMIMI = (
    "id string, name string, slug string, brand struct<name: string>, "
    "primaryCategory struct<id: string, slug: string, parentCategory: struct<id: string, slug: string, "
    "parentCategory: struct<id: string, slug: string>>>, categories array<struct<id: string, slug: string>>, "
    "variant struct<id: string, name: string, fullName: string, barcodes: array<string>, images: array<string>, "
    "storeSpecificData: array<struct<mrp: string, discount: string>>>, "
    "variants array<struct<id: string, name: string, fullName: string, barcodes: array<string>, images: array<string>, "
    "storeSpecificData: array<struct<mrp: string, discount: string>>>>"
)
BRONZE_BINDAWOOD = (
    "objectID string, master_id string, full_name_en string, name_en string, full_name_ar string, name_ar string, "
    "brand_en string, brand_ar string, image string, barcodes array<string>, price string, original_price string, "
    "inventory_modifiers map<string, struct<available: boolean, in_stock: boolean, price: string, original_price: string>>"
)
BRONZE_PANDA = (
    "id string, name string, brand struct<name: string>, _source_locale string, varieties array<struct<id: string, sku: string, "
    "description: string, barcode: string, price: string, undiscounted_price: string, size: string, unit: string, "
    "wighted: boolean, weighted_interval: string, weighted_options: array<struct<quantity_value: string, quantity_name: string, "
    "price: string, undiscounted_price: string>>, imageURL: string, images: array<string>>>"
)
REFERENCE_PRICES = (
    "gastat_id string, item_name_ar string, item_name_en string, Year int, unit_ar string, Dec string, Nov string, Oct string, "
    "`Annual average` string"
)
BRANCHES = (
    "id int, brand string, city_ar string, city_en string, name_ar string, name_en string, map_url string, LATITUDE double, LONGITUDE double"
)
STORES = ("bindawood", "panda", "tamimi")
