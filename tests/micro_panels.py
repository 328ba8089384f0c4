"""Hand-written micro panels for the edge cases of the statistics.

Rows are (bvd_id, sic, year, sales, costs_of_goods_sold, number_of_employees,
total_assets). Each case uses its own two-letter country so that the cases can share
one panel; ``NO_SURVIVOR_2013`` changes a global property (the markup anchor) and is
kept apart, as are the ``sic`` type variants.
"""

N = None

# industry 37 of AA is present at 2012 and 2014 but not 2013: no long-difference row
MISSING_FIRST_HORIZON = [
    ("AA01", 3711, 2010, 90.0, 45.0, 9.0, 190.0),
    ("AA01", 3711, 2012, 100.0, 50.0, 10.0, 200.0),
    ("AA02", 3711, 2012, 300.0, 120.0, 20.0, 500.0),
    ("AA01", 3711, 2014, 150.0, 60.0, 12.0, 210.0),
    ("AA02", 3711, 2014, 280.0, 150.0, 25.0, 480.0),
]

# AB/15 has firms in 2013 but no survivor from 2012; AB01 survives to 2014
ALL_TURNOVER_2013 = [
    ("AB01", 1520, 2012, 100.0, 40.0, 5.0, 100.0),
    ("AB02", 1520, 2012, 200.0, 90.0, 8.0, 150.0),
    ("AB03", 1520, 2013, 120.0, 50.0, 6.0, 90.0),
    ("AB01", 1520, 2014, 130.0, 60.0, 5.0, 110.0),
]

# rows with sales only, sales + cost, sales + employees, all inputs
MIXED_SAMPLES = [
    ("AC01", 2510, 2010, 90.0, N, N, 40.0),
    ("AC04", 2510, 2010, 380.0, 140.0, 33.0, 280.0),
    ("AC01", 2510, 2012, 100.0, N, N, 50.0),
    ("AC02", 2510, 2012, 200.0, 80.0, N, N),
    ("AC03", 2510, 2012, 300.0, N, 30.0, N),
    ("AC04", 2510, 2012, 400.0, 150.0, 35.0, 300.0),
    ("AC01", 2510, 2013, 110.0, N, N, 55.0),
    ("AC02", 2510, 2013, 190.0, 70.0, N, N),
    ("AC03", 2510, 2013, 330.0, N, 31.0, N),
    ("AC04", 2510, 2013, 420.0, 160.0, 36.0, 310.0),
    ("AC02", 2510, 2014, 210.0, 75.0, 4.0, 10.0),
    ("AC04", 2510, 2014, 440.0, 150.0, 37.0, 320.0),
]

# markup exactly 0.5 and 10 (kept), just outside (dropped); shares over the kept rows
TRIM_EDGES = [
    ("AD01", 3500, 2012, 50.0, 100.0, 5.0, 10.0),
    ("AD02", 3500, 2012, 1000.0, 100.0, 8.0, 20.0),
    ("AD03", 3500, 2012, 49.99, 100.0, 3.0, 5.0),
    ("AD04", 3500, 2012, 1000.1, 100.0, 9.0, 30.0),
    ("AD05", 3500, 2012, 300.0, 100.0, 4.0, 8.0),
    ("AD01", 3500, 2013, 60.0, 100.0, 5.0, 10.0),
    ("AD02", 3500, 2013, 1000.0, 100.5, 8.0, 20.0),
    ("AD03", 3500, 2013, 50.0, 100.0, 3.0, 5.0),
    ("AD04", 3500, 2013, 900.0, 100.0, 9.0, 30.0),
    ("AD05", 3500, 2013, 310.0, 100.0, 4.0, 8.0),
]

# missing firm id (so missing country) and missing industry: own cells, never paired
NULL_KEYS = [
    (N, 3711, 2012, 100.0, 50.0, 5.0, 10.0),
    (N, 3711, 2012, 300.0, 60.0, 6.0, 12.0),
    ("AE09", N, 2012, 100.0, 50.0, 5.0, 10.0),
    (N, 3711, 2013, 120.0, 50.0, 5.0, 10.0),
    ("AE09", N, 2013, 110.0, 50.0, 5.0, 10.0),
]

# zero cost, employees and assets
ZERO_DIVISORS = [
    ("AE01", 3630, 2010, 95.0, 0.0, 1.0, 0.0),
    ("AE02", 3630, 2010, 190.0, 45.0, 9.0, 90.0),
    ("AE01", 3630, 2012, 100.0, 0.0, 0.0, 0.0),
    ("AE02", 3630, 2012, 200.0, 50.0, 10.0, 100.0),
    ("AE03", 3630, 2012, 150.0, 60.0, 12.0, 80.0),
    ("AE01", 3630, 2013, 100.0, 0.0, 5.0, 0.0),
    ("AE02", 3630, 2013, 220.0, 55.0, 11.0, 105.0),
    ("AE03", 3630, 2013, 140.0, 65.0, 0.0, 85.0),
]

# AF01 moves from industry 37 to 25: not a survivor of either
SWITCHER = [
    ("AF01", 3711, 2012, 100.0, 50.0, 5.0, 10.0),
    ("AF02", 3711, 2012, 200.0, 100.0, 8.0, 20.0),
    ("AF03", 2510, 2012, 120.0, 40.0, 4.0, 15.0),
    ("AF01", 2510, 2013, 110.0, 55.0, 6.0, 11.0),
    ("AF02", 3711, 2013, 210.0, 90.0, 9.0, 25.0),
    ("AF03", 2510, 2013, 125.0, 45.0, 5.0, 16.0),
]

# negative and zero sales, negative cost / employees / assets
NEGATIVE_INPUTS = [
    ("AG01", 1520, 2012, -100.0, 50.0, 5.0, 10.0),
    ("AG02", 1520, 2012, 0.0, 50.0, 5.0, 10.0),
    ("AG03", 1520, 2012, 100.0, -50.0, -5.0, -10.0),
    ("AG04", 1520, 2012, 200.0, 80.0, 10.0, 40.0),
    ("AG01", 1520, 2013, 90.0, 45.0, 5.0, 10.0),
    ("AG03", 1520, 2013, 110.0, 50.0, -1.0, 12.0),
    ("AG04", 1520, 2013, -5.0, 80.0, 10.0, 40.0),
]

# one firm per industry-year: sigma null, covariance 0
SINGLE_FIRM = [
    ("AH01", 3711, 2010, 90.0, 40.0, 4.0, 45.0),
    ("AH01", 3711, 2012, 100.0, 40.0, 5.0, 50.0),
    ("AH01", 3711, 2013, 120.0, 50.0, 6.0, 60.0),
    ("AH01", 3711, 2014, 125.0, 55.0, 6.0, 62.0),
    ("AH01", 3711, 2015, 130.0, 52.0, 7.0, 64.0),
]

# AI01 twice at 2012 (exact copies), AI02 twice at 2012 and 2013 with different values
DUPLICATES = [
    ("AI01", 3500, 2010, 95.0, 50.0, 5.0, 10.0),
    ("AI01", 3500, 2012, 100.0, 50.0, 5.0, 10.0),
    ("AI01", 3500, 2012, 100.0, 50.0, 5.0, 10.0),
    ("AI02", 3500, 2012, 200.0, 80.0, 10.0, 20.0),
    ("AI02", 3500, 2012, 250.0, 90.0, 12.0, 25.0),
    ("AI03", 3500, 2012, 150.0, 70.0, 7.0, 14.0),
    ("AI01", 3500, 2013, 120.0, 60.0, 6.0, 12.0),
    ("AI02", 3500, 2013, 210.0, 85.0, 11.0, 22.0),
    ("AI02", 3500, 2013, 190.0, 70.0, 9.0, 18.0),
    ("AI03", 3500, 2013, 160.0, 75.0, 8.0, 15.0),
    ("AI02", 3500, 2014, 205.0, 80.0, 10.0, 21.0),
]

# five firms with equal sales: the top-4 sum does not depend on the tie order
TIES = [("AJ0%d" % i, 2510, y, 100.0, 40.0, 4.0, 20.0)
        for y in (2012, 2013) for i in range(1, 6)] + [
    ("AJ06", 2510, 2012, 500.0, 200.0, 20.0, 100.0),
    ("AJ06", 2510, 2013, 400.0, 150.0, 15.0, 90.0),
]

EDGE_PANEL = (MISSING_FIRST_HORIZON + ALL_TURNOVER_2013 + MIXED_SAMPLES + TRIM_EDGES
              + NULL_KEYS + ZERO_DIVISORS + SWITCHER + NEGATIVE_INPUTS + SINGLE_FIRM
              + DUPLICATES + TIES)

# nobody survives 2012 -> 2013 anywhere; BA survives to 2014, BB only to 2015
NO_SURVIVOR_2013 = [
    ("BA01", 3711, 2012, 100.0, 50.0, 5.0, 10.0),
    ("BA02", 3711, 2012, 200.0, 80.0, 8.0, 20.0),
    ("BA03", 3711, 2013, 150.0, 60.0, 6.0, 15.0),
    ("BA01", 3711, 2014, 120.0, 50.0, 5.0, 12.0),
    ("BA03", 3711, 2014, 160.0, 70.0, 7.0, 16.0),
    ("BB01", 2510, 2012, 100.0, 40.0, 4.0, 10.0),
    ("BB02", 2510, 2013, 110.0, 45.0, 5.0, 11.0),
    ("BB01", 2510, 2015, 105.0, 42.0, 4.0, 10.0),
    ("BB02", 2510, 2014, 115.0, 46.0, 5.0, 12.0),
]

# industry codes of several types
SIC_INT = [("CA01", 3711, 2012, 10.0, 5.0, 1.0, 1.0), ("CA02", 111, 2012, 20.0, 5.0, 1.0, 1.0)]
SIC_DOUBLE = [("CA01", 3711.0, 2012, 10.0, 5.0, 1.0, 1.0), ("CA02", 111.0, 2012, 20.0, 5.0, 1.0, 1.0)]
SIC_STRING = [("CA01", "3711", 2012, 10.0, 5.0, 1.0, 1.0), ("CA02", "111", 2012, 20.0, 5.0, 1.0, 1.0)]
