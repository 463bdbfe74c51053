"""DataFrame -> DataFrame operators of the sensor, serving and demand flows."""
