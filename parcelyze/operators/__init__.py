"""DataFrame -> DataFrame operators. They are lazy, but for exact ranks and quantiles
(ranking.py and what calls it), which write their distinct value counts first."""
