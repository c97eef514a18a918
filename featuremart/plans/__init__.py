"""The user-level products: fixed-line mart, mobile mart and training data."""
