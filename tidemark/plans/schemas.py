"""Declared schemas of the two big fact tables, for `operators.conform`."""

from __future__ import annotations

# Fixed values. VATApplicable is an unsigned byte in the source, which only a smallint can hold.
WIDE_FACT = """
FactSalesID bigint, DimRestaurantID int, DimCurrencyID int, DimTransTypeID int, DimTransDateID int, DimTransTimeID int,
DimBusinessDateID int, DimMenuItemID int, DimTransLineTypeID int, DimOrderMethodID int, DimOrderTypeID int, TransNum int,
POSRecordNum varchar(20), LineNum smallint, ParentLineNum smallint, StoreProductCode varchar(20),
StoreProductDesc varchar(30), VATApplicable smallint, VATPercentage decimal(5,5), DetailTransAmount decimal(19,6),
Quantity bigint, StoreSellingPrice decimal(19,2), DetailDiscountAmount decimal(19,6), DetailVoucherAmount decimal(19,6),
DetailStaffMealAmount decimal(19,6), StoreCostPrice decimal(19,2), DetailVATAmount decimal(19,6),
DetailSalesAmountExclVAT decimal(19,6), DetailSalesAmountExclDiscount decimal(19,6),
DetailSalesAmountDeclarable decimal(19,6), StoreSellingPriceExclVAT decimal(19,6), SalesValue decimal(19,6),
Usage decimal(19,6), BeverageQuantity bigint, FoodQuantity bigint, BeverageIncidentCount int, FoodIncidentCount int,
BeverageAndFoodIncidentCount int, ComboCount int, TransactionCount int, InsertedDateTime timestamp_ntz, FileId int
"""
NARROW_FACT = """
FactTenderID bigint, DimRestaurantID int, DimCurrencyID int, TransNum int, DimTransTypeID int, DimTransDateID int,
DimTransTimeID int, DimBusinessDateID int, DimOrderMethodID int, DimOrderTypeID int, DimTenderTypeID int,
TenderAmount decimal(19,6), InsertedDateTime timestamp_ntz, FileId int
"""
