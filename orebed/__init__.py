"""orebed: review mining, frequent itemsets, set similarity, item-based
recommendation and rating prediction as Spark DataFrame jobs."""
