"""Schemas of the sample databases, and loading a folder of exported tables.

Fixed values: table and column names with their types, as the exported files carry them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import read_table

SALES = {
    "productlines": "productLine string, textDescription string, htmlDescription string, image binary",
    "products": (
        "productCode string, productName string, productLine string, productScale string, productVendor string, "
        "productDescription string, quantityInStock smallint, buyPrice decimal(10,2), MSRP decimal(10,2)"
    ),
    "offices": (
        "officeCode string, city string, phone string, addressLine1 string, addressLine2 string, state string, "
        "country string, postalCode string, territory string"
    ),
    "employees": (
        "employeeNumber int, lastName string, firstName string, extension string, email string, officeCode string, "
        "reportsTo int, jobTitle string"
    ),
    "customers": (
        "customerNumber int, customerName string, contactLastName string, contactFirstName string, phone string, "
        "addressLine1 string, addressLine2 string, city string, state string, postalCode string, country string, "
        "salesRepEmployeeNumber int, creditLimit decimal(10,2)"
    ),
    "payments": "customerNumber int, checkNumber string, paymentDate date, amount decimal(10,2)",
    "orders": (
        "orderNumber int, orderDate date, requiredDate date, shippedDate date, status string, comments string, "
        "customerNumber int"
    ),
    "orderdetails": (
        "orderNumber int, productCode string, quantityOrdered int, priceEach decimal(10,2), orderLineNumber smallint"
    ),
}
SALES_KEYS = {
    "productlines": ("productLine",), "products": ("productCode",), "offices": ("officeCode",),
    "employees": ("employeeNumber",), "customers": ("customerNumber",), "payments": ("customerNumber", "checkNumber"),
    "orders": ("orderNumber",), "orderdetails": ("orderNumber", "productCode"),
}
SALES_REFERENCES = (
    ("products", "productLine", "productlines", "productLine"), ("employees", "officeCode", "offices", "officeCode"),
    ("employees", "reportsTo", "employees", "employeeNumber"),
    ("customers", "salesRepEmployeeNumber", "employees", "employeeNumber"),
    ("payments", "customerNumber", "customers", "customerNumber"), ("orders", "customerNumber", "customers", "customerNumber"),
    ("orderdetails", "orderNumber", "orders", "orderNumber"), ("orderdetails", "productCode", "products", "productCode"),
)
HOUSE_SALES = (
    "RCPT_YR string, CGG_CD string, CGG_NM string, STDG_CD string, STDG_NM string, LOTNO_SE string, LOTNO_SE_NM string, "
    "MNO string, SNO string, BLDG_NM string, CTRT_DAY string, THING_AMT float, ARCH_AREA float, LAND_AREA float, "
    "FLR float, RGHT_SE string, RTRCN_DAY string, ARCH_YR string, BLDG_USG string, DCLR_SE string, "
    "OPBIZ_RESTAGNT_SGG_NM string, ingestion_date date"
)
BOOKS_RAW = (
    "title string, upc string, product_type string, price_excl_tax string, price_incl_tax string, tax string, "
    "availability string, num_reviews string, description string, image_url string, url string, image_path string"
)
BOOK_METADATA = "id string, title string, upc string, price float, url string, image_path string"


def read_database(
    spark: SparkSession, folder: str, schemas: Mapping[str, str], fmt: str = "csv", register: bool = False, **options
) -> dict[str, DataFrame]:
    """Tables of a folder (``folder/name.fmt``) with their schemas, as views if asked."""
    tables = {}
    for name, schema in schemas.items():
        tables[name] = read_table(spark, f"{folder}/{name}.{fmt}", fmt, schema=schema, **options)
        if register:
            tables[name].createOrReplaceTempView(name)
    return tables
