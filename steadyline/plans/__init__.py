"""End-to-end plans: the medallion jobs, the driver-table adapter and the registered queries."""
