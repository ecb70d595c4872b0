"""Writers for the Bronze, Silver and Gold layers and for check reports."""
