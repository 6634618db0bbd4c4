"""Every operator over the driver's tables, with the same result stated in SQL."""
