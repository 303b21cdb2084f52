"""The steps of the lake: Bronze, Silver, star schema, marts, features, models, scores."""
