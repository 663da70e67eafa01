"""Hand-written raw retail tables (FIXTURES.md, set A): small decimals, one
reason per row.  ``clean=True`` drops the rows planted for the audits."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import SparkSession

from starweave.sources.schemas import SOURCE_SCHEMAS


def d(s):
    return dt.date.fromisoformat(s) if s else None


def retail_sources(spark: SparkSession, clean: bool = False) -> dict:
    customers = [
        ("C1", "Ani", "Female", 25, "Bandung", "Gold", d("2024-01-01")),
        ("C2", "Budi", "Male", 26, "Jakarta", "Silver", d("2024-01-01")),
        ("C3", "Citra", "Female", 39, "Surabaya", "Regular", d("2024-01-01")),
        ("C4", "Dedi", "Male", 40, "Bandung", "Platinum", d("2024-01-01")),
        ("C5", "Eka", "Female", 54, "Jakarta", "Gold", d("2024-01-01")),
        ("C6", "Fajar", "Male", 55, "Jakarta", "Regular", d("2024-01-01")),
        ("C7", "Gita", "Female", None, "Bekasi", "Silver", d("2024-01-01")),
    ]
    stores = [
        ("S1", "Toko A", "Mall Store", "Bandung", "Jawa Barat", "Barat"),
        ("S2", "Toko B", "Standalone Store", "Bekasi", "Jawa Barat", "Barat"),
        ("S3", "Toko C", "Mall Store", "Surabaya", "Jawa Timur", "Timur"),
        ("S4", "Toko D", "Mall Store", "Makassar", None, "Timur"),
    ]
    if not clean:
        stores.append(("S5", "Toko E", "Standalone Store", "Bandung", "Banten", "Barat"))
    suppliers = [
        ("SP1", "Sup Satu", "Jakarta", "Kitchenware", "Pak A", "Active"),
        ("SP2", "Sup Dua", "Bandung", "Furniture", "Bu B", "Active"),
    ]
    products = [
        ("P1", "Panci", "Kitchenware", "Brand1", "SP1", D("15.00"), D("10.00"), "Active"),
        ("P2", "Kursi", "Furniture", "Brand2", "SP2", D("30.00"), D("20.00"), "Active"),
        ("P3", "Rak", "Storage", "Brand1", "SP1", D("8.00"), D("5.00"), "Active"),
    ]
    campaigns = [
        ("CAM001", "Promo Satu", "Discount", d("2025-01-01"), d("2025-12-31"), "Store", D("100.00"), "Gold"),
        ("CAM002", "Promo Dua", "Cashback", d("2025-01-01"), d("2025-12-31"), "Email", D("50.00"), "All"),
    ]
    # transaction header totals are consistent with their lines (Q7)
    trx = [
        ("T1", d("2025-01-10"), "S1", "C1", "E1", "Cash", D("60.00"), D("5.00"), D("55.00"), "Success"),
        ("T2", d("2025-01-11"), "S1", "C2", "E1", "Cash", D("15.00"), D("0.00"), D("15.00"), "Cancelled"),
        ("T3", d("2025-02-05"), "S2", "C3", "E2", "E-Wallet", D("30.00"), D("0.00"), D("30.00"), "Returned"),
        ("T4", d("2025-02-14"), "S3", "C4", "E3", "Credit Card", D("53.00"), D("3.00"), D("50.00"), "Success"),
        ("T5", d("2025-04-02"), "S3", "C5", "E3", "Debit Card", D("30.00"), D("0.00"), D("30.00"), "Success"),
        ("T6", d("2024-12-31"), "S1", "C6", "E1", "Cash", D("15.00"), D("0.00"), D("15.00"), "Success"),
        ("T7", d("2025-04-20"), "S1", "C7", "E1", "Bank Transfer", D("9.00"), D("0.00"), D("9.00"), "Success"),
        ("T8", d("2025-12-29"), "S4", "C1", "E2", "Cash", D("30.00"), D("0.00"), D("30.00"), "Success"),
        ("T9", d("2025-05-05"), "S2", "C2", "E2", "Cash", D("8.00"), D("8.00"), D("0.00"), "Success"),
    ]
    details = [
        ("D1", "T1", "P1", 2, D("15.00"), D("0.00"), D("30.00")),
        ("D2", "T1", "P2", 1, D("30.00"), D("5.00"), D("25.00")),
        ("D3", "T2", "P1", 1, D("15.00"), D("0.00"), D("15.00")),
        ("D4", "T3", "P2", 1, D("30.00"), D("0.00"), D("30.00")),
        ("D5", "T4", "P1", 3, D("15.00"), D("1.00"), D("42.00")),
        ("D6", "T4", "P3", 1, D("8.00"), D("0.00"), D("8.00")),
        ("D7", "T5", "P2", 1, D("30.00"), D("0.00"), D("30.00")),
        ("D8", "T6", "P1", 1, D("15.00"), D("0.00"), D("15.00")),
        ("D9", "T7", "P9", 1, D("9.00"), D("0.00"), D("9.00")),
        ("D10", "T8", "P2", 1, D("30.00"), D("0.00"), D("30.00")),
        ("D11", "T9", "P3", 1, D("8.00"), D("8.00"), D("0.00")),
    ]
    usage = [
        ("U1", "CAM001", "T4", "C4", "PROMO10", D("1.00"), d("2025-02-14")),
        ("U2", "CAM002", "T4", "C4", "PROMO11", D("1.00"), d("2025-02-14")),
        ("U3", "CAM001", "T4", "C4", "PROMO12", D("1.00"), d("2025-02-14")),  # duplicate pair
    ]
    inventory = [
        ("K1", "P1", "S1", d("2025-01-01"), 30, 10, 15, 25, "Safe"),
        ("K2", "P2", "S1", d("2025-01-01"), 20, 0, 5, 15, "Low"),
        ("K3", "P3", "S2", d("2025-01-01"), 10, 0, 40, 0, "Out of Stock"),
    ]
    shipments = [("H1", d("2025-01-05"), "Gudang Jakarta", "S1", "P1", 10, D("100.00"), "Delivered")]
    feedback = [
        ("F1", "C1", "T1", "P1", d("2025-01-12"), 5, "bagus", "Positive", "App"),
        ("F2", "C4", "T4", "P3", d("2025-02-20"), 3, "biasa", "Neutral", "Website"),
    ]
    if not clean:
        details.append(("D12", "T2", "P3", 2, D("8.00"), D("0.00"), D("15.00")))          # Q6 and Q7
        inventory.append(("K4", "P1", "S3", d("2025-01-01"), 10, 5, 5, 9, "Safe"))         # Q8
        feedback.append(("F3", "C1", "T1", "P2", d("2025-01-13"), 1, "buruk", "Positive", "App"))  # Q9
        usage.append(("U4", "CAM002", "T2", "C2", "PROMO13", D("1.00"), d("2025-01-11")))   # Q10: Cancelled trx
        feedback.append(("F4", "C3", "T5", "P1", d("2025-05-30"), 4, "ok", "Positive", "App"))  # Q11
        customers.append(("C1", "Ani Dup", "Female", 30, "Bandung", "Gold", d("2024-01-01")))   # Q1
        stores.append(("S6", "Toko F", "Kiosk", "Depok", "Jawa Barat", "Barat"))              # Q4
    rows = {
        "customers": customers, "stores": stores, "suppliers": suppliers, "products": products,
        "marketing_campaigns": campaigns, "sales_transactions": trx, "sales_transaction_details": details,
        "promotion_usage": usage, "inventory_stock": inventory, "shipments": shipments,
        "customer_feedback": feedback,
    }
    return {t: spark.createDataFrame(r, SOURCE_SCHEMAS[t]) for t, r in rows.items()}
