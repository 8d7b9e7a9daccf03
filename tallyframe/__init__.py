"""Business-analysis operators and ready-made queries on Spark DataFrames.

``functions``  column expressions (text cleaning, dates, rounding, geometry)
``operators``  DataFrame -> DataFrame building blocks
``sources``    table loading and the adapters that shape the test tables
``plans``      the queries, one module per subject
``checks``     the same questions in SQL, used only to verify results
"""
