"""Views over the driver's tables and the catalog of registered queries."""
