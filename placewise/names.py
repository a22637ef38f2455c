"""Column names of the reports."""

# Names that existing readers of these reports rely on.
PLACE = "Place"
TEXT = "Tweet"
AUTHOR_TEXT = "Text"
AUTHOR_NAME = "Name"
LOCATION = "Location"
HOUR = "Time_In_EST"
RATIO = "ratio"
BY_DEVICE = "Tot_Tweets_By_Device"
BY_GENDER = "Tot_Tweets_By_Gender"
BY_LOCATION = "Total_Tweets_By_Location"
WITHOUT_ADDRESS = "Tweets_Not_Having_Address"
WITH_ADDRESS = "Tweets_Having_Address"
POSITIVE_WITH = "positive_tweet_having_address"
POSITIVE_WITHOUT = "positive_tweet_not_having_address"
ID = "ID"
CREATED = "Created"
POST_LOCATION = "Location_Per_Tweet"
POST_TEXT = "Tweet_Content"
USER_LOCATION = "Location_Per_User"
