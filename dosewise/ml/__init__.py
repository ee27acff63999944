"""Spark ML side: preparation, model fits, isolation forest, tree
attributions, forward-chaining tuning, tracking and bulk scoring."""
