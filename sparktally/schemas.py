"""Declared schemas of the input tables and messages."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Positional text, read as strings and cast with try_cast afterwards.
RATING_FIELDS = _strings("user_id", "movie_id", "rating", "ts")
USER_FIELDS = _strings("user_id", "gender", "age", "occupation_id", "zip")
OCCUPATION_FIELDS = _strings("occupation_id", "occupation")
MOVIE_FIELDS = _strings("movie_id", "title", "genres")

REVIEWS = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("review", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

# File name -> {header name: our name} of the commerce export (fixed names).
COMMERCE_FILES = {
    "orders": ("Orders.csv", {
        "Order_ID": "order_id",
        "Customer_Trx_ID": "customer_id",
        "Order_Purchase_Timestamp": "purchase_ts",
        "Order_Delivered_Carrier_Date": "carrier_ts",
    }),
    "customers": ("Customer_List.csv", {
        "Customer_Trx_ID": "customer_id",
        "Customer_Country": "country",
    }),
    "items": ("Order_Items.csv", {
        "Order_ID": "order_id",
        "Product_ID": "product_id",
        "Seller_ID": "seller_id",
        "Price": "price",
        "Freight_Value": "freight",
        "Shipping_Limit_Date": "shipping_limit",
    }),
    "reviews": ("Order_Reviews.csv", {
        "Order_ID": "order_id",
        "Review_Score": "score",
    }),
    "products": ("Products.csv", {
        "Product_ID": "product_id",
        "Product_Category_Name": "category",
    }),
}

RAW_FRAME = _strings("frame_id", "camera_id", "timestamp", "image_format", "image_data")

DETECTION = T.StructType([
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("class", T.StringType()),
])

DETECTION_RECORD = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("person_count", T.IntegerType()),
    T.StructField("detections", T.ArrayType(DETECTION)),
])
