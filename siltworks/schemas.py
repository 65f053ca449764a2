"""Entities of the warehouse: staging columns, typed columns, keys and relations.

The column names, lengths, numeric scales and relations below are fixed values that the
staged files and the target tables prescribe.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    """One business table in its text and typed shapes.

    ``columns`` maps the staging column, in file order, to its typed form: an optional
    length for text, or a Spark type name. ``renames`` gives the typed column name where
    it differs; ``nullable_tokens`` lists the columns in which the text NULL means null.
    """

    name: str
    keys: tuple[str, ...]
    columns: dict[str, str]
    renames: dict[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = ()
    trimmed: tuple[str, ...] = ()

    @property
    def text_table(self) -> str:
        return f"txt_{self.name}"

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed_name(self, column: str) -> str:
        return self.renames.get(column, column)


# Column order is the order of the staged files.
# "text" is unbounded text, "text(n)" at most n characters, "flag" a 0/1 marker that may be
# spelled out, "hex" binary written as hexadecimal text, "clip(n)" text cut to n characters.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in [
        Entity(
            "categories",
            ("category_id",),
            {"category_id": "int", "category_name": "text(50)", "description": "text", "picture": "hex"},
            null_tokens=("picture",),
        ),
        Entity(
            "customers",
            ("customer_id",),
            {
                "customer_id": "text(10)",
                "customer_name": "text(100)",
                "contact_name": "text(100)",
                "contact_title": "text(100)",
                "address": "text(200)",
                "city": "text(50)",
                "regions": "text(50)",
                "postal_code": "text(20)",
                "country": "text(50)",
                "phone": "text(50)",
                "fax": "text(50)",
            },
            renames={"customer_name": "company_name", "regions": "region"},
            null_tokens=("regions", "fax"),
        ),
        Entity(
            "employees",
            ("employee_id",),
            {
                "employee_id": "int",
                "last_name": "text(50)",
                "first_name": "text(50)",
                "title": "text(100)",
                "title_of_courtesy": "text(50)",
                "birth_date": "date",
                "hire_date": "date",
                "address": "text(200)",
                "city": "text(50)",
                "region": "text(50)",
                "postal_code": "text(20)",
                "country": "text(50)",
                "home_phone": "text(50)",
                "extension": "text(10)",
                "photo": "hex",
                "notes": "text",
                "reports_to": "int",
                "photo_path": "text(200)",
            },
            null_tokens=("birth_date", "hire_date", "region", "photo", "reports_to"),
        ),
        Entity(
            "employee_territories",
            ("employee_id", "territory_id"),
            {"employee_id": "int", "territory_id": "text(20)"},
        ),
        Entity(
            "products",
            ("product_id",),
            {
                "product_id": "int",
                "product_name": "text(100)",
                "supplier_id": "int",
                "category_id": "int",
                "quantity_per_unit": "text(100)",
                "unit_price": "decimal(10,2)",
                "units_in_stock": "int",
                "units_on_order": "int",
                "reorder_level": "int",
                "discontinued": "flag",
            },
            null_tokens=(
                "supplier_id",
                "category_id",
                "unit_price",
                "units_in_stock",
                "units_on_order",
                "reorder_level",
            ),
        ),
        Entity(
            "orders",
            ("order_id",),
            {
                "order_id": "int",
                "customer_id": "text(10)",
                "employee_id": "int",
                "order_date": "date",
                "required_date": "date",
                "shipped_date": "date",
                "ship_via": "int",
                "freight": "decimal(10,2)",
                "ship_name": "text(100)",
                "ship_address": "text(200)",
                "ship_city": "text(50)",
                "ship_region": "text(50)",
                "ship_postal_code": "text(20)",
                "ship_country": "text(50)",
            },
            null_tokens=(
                "employee_id",
                "order_date",
                "required_date",
                "shipped_date",
                "ship_via",
                "freight",
                "ship_region",
            ),
        ),
        Entity(
            "order_details",
            ("order_id", "product_id"),
            {
                "order_id": "int",
                "product_id": "int",
                "unit_price": "decimal(10,2)",
                "quantity": "int",
                "discount": "decimal(4,2)",
            },
        ),
        Entity(
            "regions",
            ("region_id",),
            {"region_id": "int", "region_description": "text(100)"},
            trimmed=("region_description",),
        ),
        Entity(
            "shippers",
            ("shipper_id",),
            {"shipper_id": "int", "company_name": "text(100)", "phone": "text(50)"},
        ),
        Entity(
            "suppliers",
            ("supplier_id",),
            {
                "supplier_id": "int",
                "company_name": "text(100)",
                "contact_name": "text(100)",
                "contact_title": "text(100)",
                "address": "text(200)",
                "city": "text(50)",
                "region": "text(50)",
                "postal_code": "text(20)",
                "country": "text(50)",
                "phone": "text(50)",
                "fax": "text(50)",
                "home_page": "text",
            },
            renames={"home_page": "homepage"},
            null_tokens=("region", "fax", "home_page"),
        ),
        Entity(
            "territories",
            ("territory_id",),
            {"territory_id": "text(20)", "territory_description": "text(100)", "region_id": "int"},
            trimmed=("territory_description",),
        ),
        Entity(
            "countries",
            ("country_name",),
            {
                "country_name": "text",
                "density_per_km2": "number",
                "abbreviation": "clip(5)",
                "agricultural_land_percent": "number",
                "land_area_km2": "number",
                "armed_forces_size": "int",
                "birth_rate": "number",
                "calling_code": "clip(10)",
                "capital_city": "text",
                "co2_emissions": "number",
                "cpi": "number",
                "cpi_change_percent": "number",
                "currency_code": "clip(10)",
                "fertility_rate": "number",
                "forested_area_percent": "number",
                "gasoline_price": "number",
                "gdp": "number",
                "gross_primary_education_enrollment_percent": "number",
                "gross_tertiary_education_enrollment_percent": "number",
                "infant_mortality": "number",
                "largest_city": "text",
                "life_expectancy": "number",
                "maternal_mortality_ratio": "int",
                "minimum_wage": "number",
                "official_language": "text",
                "out_of_pocket_health_expenditure_percent": "number",
                "physicians_per_thousand": "number",
                "population": "bigint",
                "labor_force_participation_percent": "number",
                "tax_revenue_percent": "number",
                "total_tax_rate_percent": "number",
                "unemployment_rate_percent": "number",
                "urban_population": "bigint",
                "latitude": "number",
                "longitude": "number",
            },
        ),
    ]
}

# An unbounded NUMERIC needs one precision in Spark.
NUMBER_TYPE = "decimal(38,10)"

# Symbols removed from the country file before it is cast.
COUNTRY_SYMBOLS: dict[str, str] = {
    "population": ",",
    "urban_population": ",",
    "gdp": ",$",
    "land_area_km2": ",",
    "armed_forces_size": ",",
    "co2_emissions": ",",
    "cpi": ",",
    "agricultural_land_percent": "%",
    "forested_area_percent": "%",
    "cpi_change_percent": "%",
    "gross_primary_education_enrollment_percent": "%",
    "gross_tertiary_education_enrollment_percent": "%",
    "out_of_pocket_health_expenditure_percent": "%",
    "labor_force_participation_percent": "%",
    "tax_revenue_percent": "%",
    "total_tax_rate_percent": "%",
    "unemployment_rate_percent": "%",
    "gasoline_price": "$",
    "minimum_wage": "$",
}

# Country spellings of the business tables and their standard names.
COUNTRY_RECODE = {
    "UK": "United Kingdom",
    "USA": "United States",
    "Ireland": "Republic of Ireland",
}

# Corrections of country attributes, addressed by abbreviation where the file
# has one and by name otherwise.
CAPITALS_BY_ABBREVIATION = {
    "LY": "Tripoli",
    "SG": "Singapore",
    "CR": "San Jose",
    "BR": "Brasilia",
    "ST": "Sao Tome",
    "TG": "Lome",
    "TO": "Nuku'alofa",
    "IS": "Reykjavik",
    "CM": "Yaounde",
    "PY": "Asuncion",
    "CO": "Bogota",
    "MV": "Male",
    "MD": "Chisinau",
}
COUNTRY_NAME_BY_ABBREVIATION = {"ST": "Sao Tome and Principe"}
COUNTRY_PATCH_BY_NAME = {
    "Palestinian National Authority": {"abbreviation": "PS", "capital_city": "Ramallah"},
}

# Parent entity, parent column, child entity, child column.
RELATIONS: list[tuple[str, str, str, str]] = [
    ("customers", "customer_id", "orders", "customer_id"),
    ("employees", "employee_id", "orders", "employee_id"),
    ("shippers", "shipper_id", "orders", "ship_via"),
    ("orders", "order_id", "order_details", "order_id"),
    ("products", "product_id", "order_details", "product_id"),
    ("suppliers", "supplier_id", "products", "supplier_id"),
    ("categories", "category_id", "products", "category_id"),
    ("employees", "employee_id", "employees", "reports_to"),
    ("regions", "region_id", "territories", "region_id"),
    ("employees", "employee_id", "employee_territories", "employee_id"),
    ("territories", "territory_id", "employee_territories", "territory_id"),
    ("dim_category", "category_key", "dim_product", "category_key"),
    ("dim_supplier", "supplier_key", "dim_product", "supplier_key"),
    ("dim_product", "product_key", "fact_table", "product_key"),
    ("dim_customer", "customer_key", "fact_table", "customer_key"),
    ("dim_employee", "employee_key", "fact_table", "employee_key"),
    ("dim_time", "date_key", "fact_table", "date_key"),
    ("dim_country", "country_name", "customers", "country"),
    ("dim_country", "country_name", "suppliers", "country"),
    ("dim_country", "country_name", "employees", "country"),
    ("dim_country", "country_name", "orders", "ship_country"),
    ("dim_country", "country_key", "dim_customer", "country_key"),
    ("dim_country", "country_key", "dim_supplier", "country_key"),
    ("dim_country", "country_key", "dim_employee", "country_key"),
]

# Columns whose missing values the exploratory profile counts, per staged table.
COMPLETENESS_COLUMNS: dict[str, list[str]] = {
    "orders": ["shipped_date", "ship_region"],
    "suppliers": ["region", "postal_code", "home_page", "fax"],
    "customers": ["regions", "postal_code", "fax"],
    "employees": ["reports_to", "region", "home_phone", "photo_path"],
    "products": ["discontinued", "reorder_level", "units_on_order"],
}
