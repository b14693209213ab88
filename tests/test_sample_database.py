"""The sales questions on a small database in its own schema, through the operators."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import cents, on_days
from millrace.operators import quality
from millrace.operators import relational as rel
from millrace.sources import schemas

ROWS = {
    "offices": ["1,Paris,p,a,,,France,75,EMEA", "2,Boston,p,a,,MA,USA,02,NA"],
    "employees": ["10,Lee,Ann,x1,a@x,1,,President", "11,Kim,Bo,x2,b@x,1,10,Sales Rep", "12,Ray,Cy,x3,c@x,2,10,Sales Rep",
                  "13,Poe,Di,x4,d@x,1,10,Sales Rep"],
    "customers": ["100,A,l,f,p,a,,c,,,FR,11,100.00", "101,B,l,f,p,a,,c,,,FR,11,300.00", "102,C,l,f,p,a,,c,,,US,12,",
                  "103,D,l,f,p,a,,c,,,US,,50.00", "104,E,l,f,p,a,,c,,,US,13,70.00"],
    "payments": ["100,c1,2003-01-05,10.00", "101,c2,2003-02-05,20.50", "102,c3,2004-01-05,5.00", "104,c4,2004-05-05,30.50"],
    "orders": ["1,2003-01-31,2003-02-02,,Shipped,,100", "2,2004-03-01,2004-03-03,,Shipped,\"late, again\",101",
               "3,2004-03-09,2004-03-12,,Shipped,,100"],
    "orderdetails": ["1,P1,2,10.50,1", "2,P1,1,10.00,1", "2,P2,1,30.00,2", "3,P2,5,30.00,1"],
    "products": ["P1,One,Cars,1:10,V,\"a, b\",5,1.00,2.00", "P2,Two,Cars,1:10,V,d,5,1.00,2.00", "P3,Three,Cars,1:10,W,d,5,1.00,2.00"],
    "productlines": ["Cars,text,,"],
}


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sales")
    for name, lines in ROWS.items():
        header = ",".join(c.split()[0] for c in schemas.SALES[name].split(", "))
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    return schemas.read_database(spark, str(folder), schemas.SALES, register=True)


def test_sample_database(database):
    assert {n: t.count() for n, t in database.items()} == {n: len(r) for n, r in ROWS.items()}
    for name, keys in schemas.SALES_KEYS.items():
        assert quality.repeated_keys(database[name], keys).count() == 0
    for child, ck, parent, pk in schemas.SALES_REFERENCES:
        assert quality.orphans(database[child], database[parent], ck, pk).count() == 0
    assert quality.repeated_keys(database["orders"], ["customerNumber"]).first()["n"] == 2


def test_average_limit_beside_each_employee(database, rows):
    out = rel.with_correlated_avg(
        database["employees"], database["customers"], "employeeNumber", "salesRepEmployeeNumber", "creditLimit", "mean_limit")
    assert rows(out.select("employeeNumber", "mean_limit")) == [(10, None), (11, 200.0), (12, None), (13, 70.0)]


def test_best_of_each_office_with_ties(database, rows):
    paid = database["payments"].join(database["customers"], "customerNumber").join(
        database["employees"], F.col("salesRepEmployeeNumber") == F.col("employeeNumber"))
    totals = rel.group_totals(paid, ["officeCode", "employeeNumber"], cents("amount"), 2, "total")
    best = rel.top_n_per_group(totals, ["officeCode"], [F.col("total").desc()], 1, "place", ties=True)
    assert rows(best.select("officeCode", "employeeNumber", F.col("total").cast("double"))) == [
        ("1", 11, 30.5), ("1", 13, 30.5), ("2", 12, 5.0)]


def test_orders_above_the_mean_of_a_year(database, rows):
    lines = database["orderdetails"].withColumn("line", F.col("quantityOrdered") * F.col("priceEach"))
    totals = lines.groupBy("orderNumber").agg(F.sum("line").cast("double").alias("total"))
    of_year = rel.semi(totals, database["orders"].filter(F.year("orderDate") == 2004), "orderNumber", "orderNumber")
    assert rows(rel.above_scalar(totals, "total", of_year.agg(F.avg("total")))) == [(3, 150.0)]


def test_same_line_and_vendor(database, rows):
    products = database["products"]
    probe = products.filter("productName = 'One'")
    same = rel.match_row_value(products, probe, ["productLine", "productVendor"])
    assert rows(same.select("productCode")) == [("P1",), ("P2",)]
    others = rel.match_row_value(products, probe, ["productLine", "productVendor"], F.col("productName") == "One")
    assert rows(others.select("productCode")) == [("P2",)]


def test_payments_of_january_buyers(database, rows):
    buyers = database["orders"].filter(on_days("orderDate", "2003-01-01", "2003-01-31"))
    paid = rel.semi(database["payments"], buyers, "customerNumber", "customerNumber")
    assert rows(paid.select("checkNumber")) == [("c1",)]
