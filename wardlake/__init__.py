"""wardlake: change-data-capture analytics on health records, built on Spark.

Row changes arrive as streams or files, are masked and appended to Bronze,
cleaned and merged into Silver (one current row per key), aggregated into Gold
marts, and read by reports, a described layer of views and note retrieval.
"""
